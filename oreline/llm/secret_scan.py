"""Finds secrets in texts: fixed patterns, and strings of high entropy; DataFrame functions only.

Positions come from the text between matches: a pattern's matches and the pieces
that splitting by the same pattern leaves alternate, so their running lengths are
the spans.  Candidate strings for the entropy test are maximal runs of a
character class; a window slides over each, and the counts of the window's characters are kept
up by one addition and one subtraction a step, with the sum of c * log2(c) beside them.
What tells that a string is no secret is asked of the whole string, or of its parts between separators, never
searched for anywhere in it: a long secret holds any short pattern by accident.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values: (kind, pattern, group whose length counts, least length).
PATTERNS = (
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    # Equal to [0-9a-f]+ with the short ones dropped: a run is taken whole or not at all.
    ("hex", r"[0-9a-f]{32,}", 0, 32),
)


@dataclass(frozen=True)
class EntropyClass:
    """Candidates of one character class.

    A window of ``window`` characters counts if its entropy reaches ``bits``; a candidate must also
    match every pattern of ``needs``, which tells keys from long words.
    """

    kind: str
    pattern: str
    window: int
    bits: float
    needs: tuple[str, ...]


#: A path (``data-``, ``//`` or ``/x/y/``) is a candidate only if a part of it is no word: words are lower case or
#: CamelCase, or upper case, with up to four digits at the end.
NO_PATH = (
    r"^(?!data[-_/]|.*//|.*/[^/]{1,12}/[^/]{1,12}/)"
    r"|(?<![^-_/=])(?=[^-_/=])(?!(?:[a-z]*(?:[A-Z][a-z]+){0,8}|[A-Z]+)[0-9]{0,4}(?:[-_/=]|$))"
)

CLASSES = (
    EntropyClass("high_hex", r"[0-9A-F]{32,}", 32, 3.0, ("[0-9]", "[A-F]")),
    EntropyClass(
        "high_base64", r"[A-Za-z0-9+/_=-]{24,}", 24, 3.9, ("[0-9]", "[A-Z]", "[a-z]", NO_PATH)
    ),
)

#: Words of made-up values.  A candidate with one is judged by what stays when the word and up to 16
#: letters or digits on either side of it are taken out.
PLACEHOLDER = r"(?i)example|sample|placeholder|changeme|dummy|redacted"

#: Candidates that match one of these as a whole are no secrets.
ALLOW = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    # Words joined by single signs.  No pattern here repeats a group without a small bound: java.util.regex recurses on
    # those, and a long candidate would end the JVM.
    r"^(?=[A-Za-z])(?!.*[-_/]{2})[A-Za-z_/-]*[-_/][A-Za-z]+$",
)

FOUND = "struct<at: int, match: string>"


#: Matches whose places are added up at once; the blocks' own places are added up after.
BLOCK = 256


def _running(items: Column, size, all_type: str, entry) -> Column:
    """(end, all): the sum of ``size(x)`` over ``items``, and ``entry(x, sum before x)`` of each, if not null."""
    return F.aggregate(
        items,
        F.struct(F.lit(0).alias("end"), F.expr(f"cast(array() as array<{all_type}>)").alias("all")),
        lambda state, x: F.struct(
            (state["end"] + size(x)).alias("end"),
            F.when(entry(x, state["end"]).isNull(), state["all"])
            .otherwise(F.concat(state["all"], F.array(entry(x, state["end"]))))
            .alias("all"),
        ),
    )


def matches(text: Column, pattern: str) -> Column:
    """Array of (at, match): leftmost matches that do not overlap, in code points.

    A text without one is settled by a search alone.  Running sums copy what they have so far, so they run over
    blocks of matches, then over blocks.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.transform(
        F.arrays_zip(gaps.alias("gap"), found.alias("match")),
        lambda p: F.struct(F.char_length(p["gap"]).alias("before"), p["match"].alias("match")),
    )

    def placed(p: Column, end: Column) -> Column:
        return F.when(
            p["match"].isNotNull(), F.struct((end + p["before"]).alias("at"), p["match"].alias("match"))
        )

    def length(p: Column) -> Column:
        return p["before"] + F.coalesce(F.char_length(p["match"]), F.lit(0))

    def joined(blocks: Column) -> Column:
        starts = _running(blocks, lambda b: b["end"], "int", lambda b, end: end)["all"]
        return F.flatten(
            F.zip_with(
                blocks,
                starts,
                lambda b, start: F.transform(
                    b["all"], lambda m: F.struct((m["at"] + start).alias("at"), m["match"].alias("match"))
                ),
            )
        )

    # one-element arrays bind what is used more than once, so that it is computed once
    blocks = F.transform(
        F.array(pairs),
        lambda all_: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / BLOCK).cast("int")),
            lambda i: _running(F.slice(all_, i * BLOCK + 1, F.lit(BLOCK)), length, FOUND, placed),
        ),
    )
    return F.when(text.rlike(pattern), F.get(F.transform(blocks, joined), F.lit(0)))


def _c_log_c(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c.cast("double"))).otherwise(F.lit(0.0))


def _slide(codes: Column, n_codes: Column, window: int, bits: float) -> Column:
    """The part that windows of ``bits`` entropy cover, first to last, or -1.

    Entropy of a window of W characters is log2(W) - S / W, with S the sum of c * log2(c)
    over its characters' counts c.
    """
    most = window * (F.log2(F.lit(float(window))) - bits) + 1e-9
    start = F.struct(
        F.array_repeat(F.lit(0), n_codes).alias("counts"),
        F.lit(0.0).alias("s"),
        F.lit(-1).alias("low"),
        F.lit(-1).alias("high"),
        F.lit(0).alias("i"),
    )

    def step(state: Column, code: Column) -> Column:
        i = state["i"]
        # the character that leaves; none while the first window fills
        gone = F.when(i >= window, F.get(codes, i - window)).otherwise(F.lit(-1))
        c_in = F.get(state["counts"], code)
        c_in = F.when(gone == code, c_in - 1).otherwise(c_in)
        c_out = F.when(gone >= 0, F.get(state["counts"], gone)).otherwise(F.lit(0))
        s = state["s"] - _c_log_c(c_out) + _c_log_c(c_out - 1)
        s = s - _c_log_c(c_in) + _c_log_c(c_in + 1)
        counts = F.transform(
            state["counts"],
            lambda c, j: c + (j == code).cast("int") - (j == gone).cast("int"),
        )
        hot = (i >= window - 1) & (s <= most)
        return F.struct(
            counts.alias("counts"),
            s.alias("s"),
            F.when(hot & (state["low"] < 0), i - window + 1).otherwise(state["low"]).alias("low"),
            F.when(hot, i + 1).otherwise(state["high"]).alias("high"),
            (i + 1).alias("i"),
        )

    return F.aggregate(codes, start, step, lambda s: F.struct(s["low"], s["high"]))


def find_secrets(
    docs: DataFrame,
    classes: tuple[EntropyClass, ...] = CLASSES,
    allow: tuple[str, ...] = ALLOW,
    placeholder: str = PLACEHOLDER,
) -> DataFrame:
    """``docs`` with ``spans``, an array of (start, kind_no, kind, end), in that order.

    Kinds are those of the patterns, then those of the entropy ``classes``.  Positions are code points, the end exclusive.  ``allow``
    and ``placeholder`` suppress entropy candidates only, never a pattern's match.  A null text is empty; rows may
    repeat, and are judged one by one.  An input column called ``spans`` is replaced.
    """
    kinds = [(k, p, g, n) for k, p, g, n in PATTERNS]
    kinds += [(c.kind, c.pattern, 0, c.window) for c in classes]
    text = F.coalesce("text", F.lit(""))
    # The row travels packed, so that no name of it can clash.
    frame = docs.select(F.struct("*").alias("row"), *[matches(text, p).alias(f"_{k}") for k, p, _, _ in kinds])

    def plain(number: int, kind: str, pattern: str, group: int, least: int) -> Column:
        def counted(m: Column) -> Column:
            return F.char_length(F.regexp_extract(m["match"], pattern, group) if group else m["match"])

        return F.transform(
            F.filter(F.col(f"_{kind}"), lambda m: counted(m) >= least),
            lambda m: _span(m["at"], F.lit(number), kind, m["at"] + F.char_length(m["match"])),
        )

    def entropic(number: int, c: EntropyClass) -> Column:
        def fitting(match: Column) -> Column:
            fits = F.lit(True)
            for pattern in c.needs:
                fits = fits & match.rlike(pattern)
            for pattern in allow:
                fits = fits & ~match.rlike(pattern)
            return fits

        def judged(m: Column) -> Column:
            around = "(?i)[A-Za-z0-9]{0,16}(?:" + placeholder.removeprefix("(?i)") + ")[A-Za-z0-9]{0,16}"
            parts = F.regexp_extract_all(
                F.regexp_replace(m["match"], around, " "), F.lit(c.pattern), F.lit(0)
            )
            left = F.exists(parts, lambda p: fitting(p) & (slid(p)["low"] >= 0))
            return fitting(m["match"]) & (~m["match"].rlike(placeholder) | left)

        def slid(match: Column) -> Column:
            chars = F.split(match, "")
            # one-element arrays bind what is used many times, so that it is computed once
            bound = F.transform(
                F.array(F.struct(chars.alias("c"), F.array_distinct(chars).alias("a"))),
                lambda b: F.struct(
                    F.transform(b["c"], lambda x: F.array_position(b["a"], x).cast("int") - 1).alias(
                        "codes"
                    ),
                    F.size(b["a"]).alias("n"),
                ),
            )
            hot = F.transform(bound, lambda b: _slide(b["codes"], b["n"], c.window, c.bits))
            return F.get(hot, F.lit(0))

        def measured(m: Column) -> Column:
            return F.struct(m["at"].alias("at"), slid(m["match"]).alias("hot"))

        found = F.transform(F.filter(F.col(f"_{c.kind}"), judged), measured)
        return F.transform(
            F.filter(found, lambda m: m["hot"]["low"] >= 0),
            lambda m: _span(
                m["at"] + m["hot"]["low"], F.lit(number), c.kind, m["at"] + m["hot"]["high"]
            ),
        )

    none = F.expr("cast(array() as array<struct<start: int, kind_no: int, kind: string, end: int>>)")
    groups = [
        F.coalesce(plain(i, *kind), none) for i, kind in enumerate(PATTERNS)
    ] + [
        F.coalesce(entropic(i, c), none) for i, c in enumerate(classes, len(PATTERNS))
    ]
    others = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() != "spans"]
    return frame.select("row", F.array_sort(F.concat(*groups)).alias("spans")).select(*others, "spans")


def _span(start: Column, number: Column, kind: str, end: Column) -> Column:
    return F.struct(
        start.alias("start"), number.alias("kind_no"), F.lit(kind).alias("kind"), end.alias("end")
    )
