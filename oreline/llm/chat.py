"""Chat formatting: records of many layouts become canonical turns, and turns become marked text with a loss mask.

1. Fingerprint.  The nested field paths that a record has, as far as some layout names them, are sorted and hashed.  A table of rows
   has one fingerprint, from its schema; a table of JSON texts has one per row, from its values.  Other
   fields are ignored, so extra columns change nothing.
2. Mapping.  The fingerprint selects a declarative :class:`Layout`: where the turns, their roles and texts are.  No two
   layouts may share a fingerprint.
3. Template.  Each turn is written between marks of its role.  Control strings inside a text (all marks) get a backslash in front, and
   every mark of the template follows a line start or a blank, never a backslash; so marks without a backslash are
   the template's own, and taking one backslash from each other mark gives the text back.
4. Loss mask.  Run lengths, one entry per turn: code points before the part to learn from, in it, and after it.

All of it is column expressions: no Python runs on the executors.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TURNS = "array<struct<role: string, text: string>>"


# --- layouts ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Layout:
    """Where a record keeps its turns.

    ``turns``: (role, fields) in order, the texts of the fields joined by an empty line; or ``each``: the path of an array whose
    elements have ``role`` and ``text``; or ``rows``: each row is one turn, with a conversation ``key`` and an ``order``.
    ``optional`` fields may be missing, and null or empty ones give no text; a turn none of whose fields has a text is left out.
    """

    name: str
    turns: tuple[tuple[str, tuple[str, ...]], ...] = ()
    each: str = ""
    rows: bool = False
    key: str = ""
    order: str = ""
    role: str = "role"
    text: str = "text"
    optional: tuple[str, ...] = ()
    #: Names of roles as canonical ones; others stay.
    roles: tuple[tuple[str, str], ...] = ()

    def paths(self) -> tuple[str, ...]:
        if self.rows:
            return (self.key, self.order, self.role, self.text)
        if self.each:
            return (*self.optional, self.each, f"{self.each}[].{self.role}", f"{self.each}[].{self.text}")
        return tuple(f for _, fields in self.turns for f in fields)

    def fingerprints(self) -> set[str]:
        """Of every set of paths the layout may come with; an empty array has no element paths."""
        fixed = [p for p in self.paths() if p not in self.optional]
        wholes = [fixed, [self.each]] if self.each else [fixed]
        return {
            fingerprint([*whole, *some])
            for whole in wholes
            for n in range(len(self.optional) + 1)
            for some in combinations(self.optional, n)
        }


#: Layouts in common use.
LAYOUTS = (
    Layout("turn_rows", rows=True, key="conv_id", order="turn"),
    Layout("messages", each="messages", text="content", optional=("system",)),
    Layout(
        "shared_conversation",
        each="conversations",
        role="from",
        text="value",
        optional=("system",),
        roles=(("human", "user"), ("gpt", "assistant")),
    ),
    Layout(
        "instruction",
        turns=(("system", ("system",)), ("user", ("instruction", "input")), ("assistant", ("output",))),
        optional=("system", "input"),
    ),
    Layout("prompt_completion", turns=(("user", ("prompt",)), ("assistant", ("completion",)))),
    Layout(
        "prompt_response",
        turns=(("system", ("system",)), ("user", ("prompt",)), ("assistant", ("response",))),
        optional=("system",),
    ),
    Layout("question_answer", turns=(("user", ("question",)), ("assistant", ("answer",)))),
)


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _by_fingerprint(layouts: Sequence[Layout]) -> dict[str, Layout]:
    found: dict[str, Layout] = {}
    for layout in layouts:
        for print_ in layout.fingerprints():
            if print_ in found:
                raise ValueError(f"layouts {found[print_].name} and {layout.name} share a fingerprint")
            found[print_] = layout
    return found


def vocabulary(layouts: Sequence[Layout]) -> list[str]:
    return sorted({p for layout in layouts for p in layout.paths()})


def field_paths(schema: T.DataType, prefix: str = "") -> list[str]:
    """The nested field paths of a schema; those of array elements contain ``[]``."""
    if isinstance(schema, T.ArrayType):
        return field_paths(schema.elementType, f"{prefix}[]")
    if not isinstance(schema, T.StructType):
        return []
    found = []
    for f in schema.fields:
        path = f"{prefix}.{f.name}" if prefix else f.name
        found += [path, *field_paths(f.dataType, path)]
    return found


# --- canonical turns -------------------------------------------------------------------------------------


def _role(layout: Layout, role: Column) -> Column:
    known = role
    for name, canonical in layout.roles:
        known = F.when(role == name, F.lit(canonical)).otherwise(known)
    return known


def _listed(layout: Layout, text_of, elements) -> Column:
    """The turns of one record: ``text_of`` gives a field's text, ``elements`` the (role, text) of an array."""
    if layout.each:
        system = [
            F.when(
                F.coalesce(text_of(p), F.lit("")) != "",
                F.array(F.struct(F.lit("system").alias("role"), text_of(p).alias("text"))),
            )
            for p in layout.optional
        ]
        empty = F.array().cast(TURNS)
        return F.concat(
            *[F.coalesce(s.cast(TURNS), empty) for s in system],
            F.coalesce(elements(layout).cast(TURNS), empty),
        )
    turns = []
    for role, fields in layout.turns:
        given = F.filter(F.array(*[text_of(f) for f in fields]), lambda t: F.coalesce(t, F.lit("")) != "")
        turns.append(
            F.struct(
                F.lit(role).alias("role"),
                F.when(F.size(given) > 0, F.array_join(given, "\n\n")).alias("text"),
            )
        )
    return F.filter(F.array(*turns), lambda t: t["text"].isNotNull()).cast(TURNS)


def turns_of_json(records: DataFrame, column: str, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """``records`` with ``layout`` and ``turns`` behind their columns, from JSON texts of mixed layouts.

    Null, broken and unknown records have a null ``layout`` and no turns; nothing is dropped.  Input columns called
    ``layout`` or ``turns`` are replaced.  A role or text that is no string is taken as its JSON text.
    """
    layouts = [x for x in layouts if not x.rows]
    # One evaluation of the parser per row: later steps read the packed value.
    packed = records.select(F.struct("*").alias("row"), F.try_parse_json(F.col(f"`{column}`")).alias("value"))

    def at(value: Column, path: str, kind: str) -> Column:
        return F.try_variant_get(value, F.lit("$" + "".join(f'["{p}"]' for p in path.split("."))), kind)

    def text(value: Column, path: str) -> Column:
        return at(value, path, "string")

    def present(path: str) -> Column:
        array, _, inner = path.partition("[].")
        if not inner:
            return at(F.col("value"), array, "variant").isNotNull()
        return F.exists(
            at(F.col("value"), array, "array<variant>"), lambda x: at(x, inner, "variant").isNotNull()
        )

    paths = vocabulary(layouts)
    printed = packed.withColumn(
        "print",
        F.sha2(
            F.array_join(
                F.filter(
                    F.array(*[F.when(F.coalesce(present(p), F.lit(False)), F.lit(p)) for p in paths]),
                    lambda p: p.isNotNull(),
                ),
                "\n",
            ),
            256,
        ),
    )

    def elements(layout: Layout) -> Column:
        return F.transform(
            at(F.col("value"), layout.each, "array<variant>"),
            lambda x: F.struct(
                _role(layout, text(x, layout.role)).alias("role"), text(x, layout.text).alias("text")
            ),
        )

    name, turns = F.lit(None).cast("string"), F.array().cast(TURNS)
    prints = _by_fingerprint(layouts)
    for layout in layouts:
        mine = F.col("print").isin(sorted(p for p, x in prints.items() if x is layout))
        name = F.when(mine, F.lit(layout.name)).otherwise(name)
        turns = F.when(mine, _listed(layout, lambda p: text(F.col("value"), p), elements)).otherwise(turns)
    others = [c for c in records.columns if c.lower() not in ("layout", "turns")]
    return printed.select(
        *[F.col("row")[c].alias(c) for c in others], name.alias("layout"), turns.alias("turns")
    )


def layout_of(schema: T.StructType, layouts: Sequence[Layout] = LAYOUTS) -> Layout | None:
    """The layout that the fingerprint of a table's schema selects."""
    known = set(vocabulary(layouts))
    return _by_fingerprint(layouts).get(fingerprint(known & set(field_paths(schema))))


def canonical_turns(records: DataFrame, layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """A table whose schema has a known fingerprint as conversations with ``turns``: array of (role, text).

    Layouts of one record a row keep their columns; ``turns`` is behind them, in place of a column of that name.  Where each row is a
    turn, the result is the layout's key and ``turns``, in the order of its ``order`` (nulls first; ties, and rows that
    repeat, by role and text).  A row without a key belongs to no conversation and is one of its own, with a null key.
    A null text is empty, a null role is "".  A schema that no layout fits is refused.

    A conversation's rows meet in one task, as its text is one value of the result; each input partition sends one list per key.
    """
    layout = layout_of(records.schema, layouts)
    if layout is None:
        raise ValueError(f"no layout has the fields {field_paths(records.schema)}")

    def turn(role: Column, text: Column) -> Column:
        return F.struct(
            F.coalesce(_role(layout, role.cast("string")), F.lit("")).alias("role"),
            F.coalesce(text.cast("string"), F.lit("")).alias("text"),
        )

    if layout.rows:
        key = F.col(layout.key)
        turns = records.select(
            key.alias("key"),
            F.when(key.isNull(), F.monotonically_increasing_id()).alias("lone"),
            F.struct(F.col(layout.order).alias("at"), turn(F.col(layout.role), F.col(layout.text)).alias("turn")).alias("placed"),
        )
        return (
            turns.groupBy("key", "lone")
            .agg(F.array_sort(F.collect_list("placed")).alias("placed"))
            .select(F.col("key").alias(layout.key), F.transform("placed", lambda p: p["turn"]).alias("turns"))
        )

    def text_of(path: str) -> Column:
        return F.col(path).cast("string") if path in have else F.lit(None).cast("string")

    def elements(_: Layout) -> Column:
        return F.transform(F.col(layout.each), lambda x: turn(x[layout.role], x[layout.text]))

    have = set(field_paths(records.schema))
    return records.select(
        *[c for c in records.columns if c.lower() != "turns"], _listed(layout, text_of, elements).alias("turns")
    )


# --- template --------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Template:
    """Marks before and after a turn, by role; other roles are written out between marks of their own."""

    marks: dict[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "system": ("<<SYS>>", "<</SYS>>"),
            "user": ("[INST]", "[/INST]"),
            "assistant": ("<s>", "</s>"),
        }
    )
    other: tuple[str, str, str] = ("[ROLE]", "[TEXT]", "[/ROLE]")
    #: Roles whose texts are learnt from.
    learn: tuple[str, ...] = ("assistant",)

    def __post_init__(self):
        marks = [m for pair in self.marks.values() for m in pair] + [*self.other]
        if len(set(marks)) < len(marks):
            raise ValueError("marks must differ")
        for one in marks:
            if not one or re.search(r"[\s\\]", one):
                raise ValueError("marks must not be empty or hold blanks or backslashes")
            for two in marks:
                overlaps = any(one.endswith(two[:n]) for n in range(1, min(len(one), len(two) + 1)))
                if one != two and (two in one or overlaps):
                    raise ValueError(f"marks {one} and {two} overlap")

    def controls(self) -> str:
        """A pattern of all marks."""
        marks = [m for pair in self.marks.values() for m in pair] + [*self.other]
        return "|".join(re.escape(m) for m in marks)

    def escape(self, text: Column) -> Column:
        return F.regexp_replace(text, f"({self.controls()})", r"\\$1")

    def unescape(self, text: Column) -> Column:
        return F.regexp_replace(text, rf"\\({self.controls()})", "$1")


def _chars(column: Column) -> Column:
    return F.char_length(column).cast("long")


def format_turns(conversations: DataFrame, template: Template | None = None) -> DataFrame:
    """``conversations`` (with ``turns``) with ``formatted`` and ``loss_mask`` in place of ``turns``.

    ``loss_mask``: for each turn the code points ``before`` the part to learn from, ``learn`` in it, and ``after`` it; a turn
    of another role is all ``before``.  No turns, or null ones, give an empty text and mask.  Input columns of the new names are replaced.
    """
    template = template or Template()

    def head(role: Column) -> Column:
        open_, middle, _ = template.other
        text = F.concat(F.lit(f"{open_} "), template.escape(role), F.lit(f" {middle} "))
        for known, (mark, _) in template.marks.items():
            text = F.when(role == known, F.lit(f"{mark} ")).otherwise(text)
        return text

    def tail(role: Column) -> Column:
        text = F.lit(f" {template.other[2]}\n")
        for known, (_, mark) in template.marks.items():
            text = F.when(role == known, F.lit(f" {mark}\n")).otherwise(text)
        return text

    def learnt(role: Column) -> Column:
        return role.isin(*template.learn) if template.learn else F.lit(False)

    def piece(t: Column) -> Column:
        role, text = F.coalesce(t["role"], F.lit("")), F.coalesce(t["text"], F.lit(""))
        return F.struct(
            head(role).alias("head"),
            template.escape(text).alias("text"),
            tail(role).alias("tail"),
            learnt(role).alias("learnt"),
        )

    def entry(p: Column) -> Column:
        parts = [_chars(p[c]) for c in ("head", "text", "tail")]
        none = F.lit(0).cast("long")
        return F.struct(
            F.when(p["learnt"], parts[0]).otherwise(parts[0] + parts[1] + parts[2]).alias("before"),
            F.when(p["learnt"], parts[1]).otherwise(none).alias("learn"),
            F.when(p["learnt"], parts[2]).otherwise(none).alias("after"),
        )

    others = [c for c in conversations.columns if c.lower() not in ("turns", "formatted", "loss_mask")]
    pieces = conversations.select(
        F.struct(*others).alias("row") if others else F.lit(None).alias("row"),
        F.transform(F.coalesce("turns", F.array().cast(TURNS)), piece).alias("pieces"),
    )
    return pieces.select(
        *[F.col("row")[c].alias(c) for c in others],
        F.array_join(
            F.transform("pieces", lambda p: F.concat(p["head"], p["text"], p["tail"])), ""
        ).alias("formatted"),
        F.transform("pieces", entry).alias("loss_mask"),
    )


def read_turns(formatted: DataFrame, template: Template | None = None) -> DataFrame:
    """``formatted`` with ``turns`` and ``learnt`` (the texts under the loss mask, in order) read back from text and mask.

    The text is cut before every mark that opens a turn and has no backslash in front; roles come from the marks, and
    the texts under the mask from its run lengths.
    """
    template = template or Template()
    opening = [m for m, _ in template.marks.values()] + [template.other[0]]
    cut = rf"(?<!\\)(?={'|'.join(re.escape(m) for m in opening)})"

    def turn(p: Column) -> Column:
        role = text = None
        open_, middle, close = template.other
        # The role ends where its escaped text ends: at the first middle mark without a backslash.
        rest = F.regexp_replace(p, rf"(?s)^{re.escape(open_)} .*? (?<!\\){re.escape(middle)} ", "")
        size = _chars(p) - _chars(rest) - len(f"{open_}  {middle} ")
        role = F.substring(p, F.lit(len(open_) + 2), size.cast("int"))
        text = F.substring(rest, F.lit(1), (_chars(rest) - len(f" {close}\n")).cast("int"))
        for known, (first, last) in template.marks.items():
            mine = p.startswith(f"{first} ")
            inner = _chars(p) - len(f"{first}  {last}\n")
            role = F.when(mine, F.lit(known)).otherwise(role)
            text = F.when(mine, F.substring(p, F.lit(len(first) + 2), inner.cast("int"))).otherwise(text)
        return F.struct(template.unescape(role).alias("role"), template.unescape(text).alias("text"))

    def under_mask(p: Column, m: Column) -> Column:
        return F.when(
            m["after"] > 0,
            template.unescape(F.substring(p, (m["before"] + 1).cast("int"), m["learn"].cast("int"))),
        )

    others = [c for c in formatted.columns if c.lower() not in ("turns", "learnt")]
    pieces = formatted.select(
        F.struct(*others).alias("row"),
        F.when(F.col("formatted") == "", F.array().cast("array<string>"))
        .otherwise(F.split("formatted", cut))
        .alias("pieces"),
    )
    return pieces.select(
        *[F.col("row")[c].alias(c) for c in others],
        F.transform("pieces", turn).alias("turns"),
        F.filter(
            F.zip_with("pieces", F.col("row")["loss_mask"], under_mask), lambda t: t.isNotNull()
        ).alias("learnt"),
    )


#: What the query over ``conversations`` returns, in DuckDB SQL; the marks are the default template's.
SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *, length(regexp_replace(text, '(<</?SYS>>|\[/?INST\]|</?s>|\[/?ROLE\]|\[TEXT\])', '\\\1', 'g'))
    + CASE role WHEN 'system' THEN 18 WHEN 'user' THEN 16 WHEN 'assistant' THEN 10
      ELSE 24 + length(regexp_replace(role, '(<</?SYS>>|\[/?INST\]|</?s>|\[/?ROLE\]|\[TEXT\])', '\\\1', 'g')) END AS size
  FROM rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(size)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
