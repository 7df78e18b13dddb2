"""Chat formatting: records of differing layouts become canonical turns, and turns one marked text with a loss mask.

Layouts are told apart by a schema fingerprint: the 64-bit hash of a record's nested field paths, without types and in sorted
order. A registry maps fingerprints to declarative mappings (an array of turns with a role and a text field, or a list of
single fields with fixed roles), so one table may mix prompt, instruction and message layouts. A record of an unknown layout
keeps its fingerprint and has NULL turns; it is never guessed or dropped.

Template: every turn is ``<|role|>`` newline, text, ``</s>`` newline. Inside texts and roles a backslash is doubled and ``\\.`` is put after each
``<`` and ``[`` (in roles also after ``|``), so no control string that starts with one of them, of this template or of a
common other one, can appear; reading back undoes it exactly. The loss mask is the list of character spans of the assistant's
(escaped) texts.

Everything is DataFrame functions; no Python runs on the executors. Tables of one turn a row have layouts of their own: a row's fingerprint is
taken from its columns and chooses its mapping, and turns are formatted, read back and measured row by row, without a record. Only the digests need a conversation's turns together, in one task; its texts
may then have 2 GiB, the most that one string of Spark holds, beyond which the job stops. Conversations are spread over tasks.

NULL texts and roles count as empty; a NULL turn number comes first; turns with equal numbers are ordered by role and text, and
repeated rows all stay. Rows with a NULL conv_id form one conversation of that id. A record whose list of turns is empty has no field
paths below it and counts as an unknown layout. Spark holds a JSON record as a variant, which may have at most 128 MiB; a larger one
has no layout. Turn rows have no such bound.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradevault.llm.columns import fresh, named

TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Messages:
    """An array of objects: ``$.<field>[*].<role>`` and ``.<text>``; other object fields in ``more``. ``names`` maps role names."""

    field: str
    role: str
    text: str
    more: tuple[str, ...] = ()
    names: tuple[tuple[str, str], ...] = ()

    def paths(self) -> list[str]:
        return [self.field, *[f"{self.field}.{x}" for x in (self.role, self.text, *self.more)]]

    def turns(self, record: Column) -> Column:
        kinds = ",".join(f"`{x}`:string" for x in (self.role, self.text))
        items = F.try_variant_get(record, f"$.{self.field}", f"array<struct<{kinds}>>")
        return F.transform(items, lambda t: F.struct(renamed(t[self.role], self.names).alias("role"), F.coalesce(t[self.text], F.lit("")).alias("text")))


@dataclass(frozen=True)
class Fields:
    """Single top-level fields with fixed roles, in order; fields of one role next to each other are joined by a newline."""

    turns_of: tuple[tuple[str, str], ...]
    more: tuple[str, ...] = ()

    def paths(self) -> list[str]:
        return [*[f for f, _ in self.turns_of], *self.more]

    def turns(self, record: Column) -> Column:
        made: list[tuple[str, list[Column]]] = []
        for field, role in self.turns_of:
            value = F.nullif(F.try_variant_get(record, f"$.{field}", "string"), F.lit(""))
            if made and made[-1][0] == role:
                made[-1][1].append(value)
            else:
                made.append((role, [value]))
        return F.array(*[F.struct(F.lit(role).alias("role"), F.concat_ws("\n", *parts).alias("text")) for role, parts in made])


@dataclass(frozen=True)
class Turn:
    """One turn per table row: a role and a text column; other columns in ``more``. ``names`` maps role names."""

    role: str
    text: str
    more: tuple[str, ...] = ()
    names: tuple[tuple[str, str], ...] = ()

    def paths(self) -> list[str]:
        return [self.role, self.text, *self.more]

    def turn(self, have: set[str]) -> Column:
        role, text = (F.col(f"`{c}`").cast("string") if c in have else F.lit(None).cast("string") for c in (self.role, self.text))
        return F.struct(renamed(role, self.names).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def renamed(role: Column, names: tuple[tuple[str, str], ...]) -> Column:
    out = F.coalesce(role, F.lit(""))
    for old, new in names:
        out = F.when(role == old, F.lit(new)).otherwise(out)
    return out


#: Layout name -> mapping. The turn number of ``rows`` only orders the turns when the record is made.
LAYOUTS: dict[str, Messages | Fields] = {
    "rows": Messages("turns", "role", "text", ("turn",)),
    "messages": Messages("messages", "role", "content"),
    "speakers": Messages("conversations", "from", "value", (), (("human", "user"), ("gpt", "assistant"))),
    "prompt": Fields((("prompt", "user"), ("completion", "assistant"))),
    "question": Fields((("system", "system"), ("question", "user"), ("answer", "assistant"))),
    "instruction": Fields((("instruction", "user"), ("input", "user"), ("output", "assistant"))),
    "instruction_only": Fields((("instruction", "user"), ("output", "assistant"))),
}


#: Layouts of tables with one turn a row.
ROW_LAYOUTS: dict[str, Turn] = {
    "turn_rows": Turn("role", "text", ("turn",)),
    "message_rows": Turn("role", "content", ("turn",)),
    "speaker_rows": Turn("from", "value", ("turn",), (("human", "user"), ("gpt", "assistant"))),
}


def signature(schema: Column) -> Column:
    """A schema text without types: only field names and nesting remain."""
    bare = F.regexp_replace(schema, r"(: )?\b(STRING|VOID|BIGINT|DOUBLE|BOOLEAN|VARIANT|FLOAT|DECIMAL\(\d+, ?\d+\))\b(?=[,>]|$)", "")
    return F.regexp_replace(bare, r"(: )?\bARRAY(<>|\b(?!<))", "")


def fingerprint(record: Column) -> Column:
    """Hash of the nested field paths of a variant; NULL for a NULL record."""
    return F.when(record.isNotNull(), F.xxhash64(signature(F.schema_of_variant(record))))


def layout_signature(mapping: Messages | Fields | Turn) -> str:
    """What ``signature`` gives for a record of this layout."""
    if isinstance(mapping, (Fields, Turn)):
        return f"OBJECT<{', '.join(sorted(mapping.paths()))}>"
    inner = ", ".join(sorted((mapping.role, mapping.text, *mapping.more)))
    return f"OBJECT<{mapping.field}: ARRAY<OBJECT<{inner}>>>"


def canonical(records: DataFrame, column: str, into: str = "turns", layouts: dict[str, Messages | Fields] | None = None) -> DataFrame:
    """``records`` with ``layout`` and canonical turns of the JSON text in ``column``; columns ``layout``, ``fingerprint`` and ``into`` are replaced."""
    layouts = LAYOUTS if layouts is None else layouts
    variant = fresh(records, "record")
    out = records.withColumn(variant, F.try_parse_json(F.col(f"`{column}`"))).withColumn("fingerprint", fingerprint(F.col(variant)))
    turns, name = F.lit(None).cast(TURNS), F.lit(None).cast("string")
    for layout, mapping in reversed(layouts.items()):
        hit = F.col("fingerprint") == F.xxhash64(F.lit(layout_signature(mapping)))
        turns = F.when(hit, mapping.turns(F.col(variant)).cast(TURNS)).otherwise(turns)
        name = F.when(hit, F.lit(layout)).otherwise(name)
    return out.withColumn("layout", name).withColumn(into, turns).drop(variant)


def canonical_rows(rows: DataFrame, fields: list[str], into: str = "t", layouts: dict[str, Turn] | None = None) -> DataFrame:
    """Turn rows with their fingerprint, layout and canonical turn; columns ``fingerprint``, ``layout`` and ``into`` are replaced.

    A row's fingerprint is that of a record of its ``fields`` with all values emptied, as paths do not depend on them; so no text is copied
    into a record, and a text has no bound but a string's. A row of an unknown layout keeps its fingerprint and has a NULL turn.
    """
    layouts = ROW_LAYOUTS if layouts is None else layouts
    shape = F.struct(*[F.substring(F.col(f"`{c}`").cast("string"), 1, 0).alias(c) for c in fields])
    out = rows.withColumn("fingerprint", fingerprint(F.to_variant_object(shape)))
    turn, name = F.lit(None).cast("struct<role:string,text:string>"), F.lit(None).cast("string")
    for layout, mapping in reversed(layouts.items()):
        hit = F.col("fingerprint") == F.xxhash64(F.lit(layout_signature(mapping)))
        turn = F.when(hit, mapping.turn(set(fields))).otherwise(turn)
        name = F.when(hit, F.lit(layout)).otherwise(name)
    return out.withColumn("layout", name).withColumn(into, turn)


def turn_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of turn rows, in the types of the ``rows`` layout."""
    return rows.select(
        named(rows, "conv_id").cast("long").alias("conv_id"),
        named(rows, "turn").cast("long").alias("turn"),
        F.coalesce(named(rows, "role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(named(rows, "text").cast("string"), F.lit("")).alias("text"),
    )


def conversation_records(rows: DataFrame) -> DataFrame:
    """Turn rows as one JSON record per conversation, in the ``rows`` layout."""
    flat = turn_rows(rows).select("conv_id", F.struct("turn", "role", "text").alias("t"))
    listed = flat.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return listed.select("conv_id", F.to_json(F.struct("turns"), {"ignoreNullFields": "false"}).alias("record"))


def escape(text: Column, marks: str = r"<\[") -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), f"([{marks}])", r"$1\\.")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(?:\.|(\\))", "$1")


def header(role: Column) -> Column:
    return F.concat(F.lit("<|"), escape(role, r"<\[|"), F.lit("|>\n"))


def formatted(turns: Column) -> Column:
    """The marked text of canonical turns."""
    return F.array_join(F.transform(turns, lambda t: F.concat(header(t["role"]), escape(t["text"]), F.lit("</s>\n"))), "")


def loss_spans(turns: Column) -> Column:
    """(start, end) characters of the assistant's texts in the marked text, end exclusive."""

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(header(t["role"]))
        end = start + F.length(escape(t["text"]))
        span = F.when(t["role"] == "assistant", F.array(F.struct(start.alias("a"), end.alias("b")))).otherwise(F.array().cast("array<struct<a:int,b:int>>"))
        return F.struct((end + 5).alias("at"), F.concat(state["spans"], span).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("spans"))
    return F.aggregate(turns, begin, step, lambda s: s["spans"])


def read_back(text: Column) -> Column:
    """The turns of a marked text."""
    parts = F.filter(F.split(text, "</s>\n"), lambda p: p != "")
    cut = lambda p: F.instr(p, "|>\n")
    return F.transform(
        parts, lambda p: F.struct(unescape(F.substring(p, F.lit(3), cut(p) - 3)).alias("role"), unescape(F.substring(p, cut(p) + 3, F.length(p))).alias("text"))
    )


def under_mask(text: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(text, s["a"] + 1, s["b"] - s["a"]))), "")


def format_records(records: DataFrame, column: str = "record") -> DataFrame:
    """``records`` with ``layout``, ``fingerprint``, ``turns``, ``formatted`` and ``loss_spans`` (replaced if present; NULL for unknown layouts)."""
    out = canonical(records, column)
    return out.withColumn("formatted", formatted(F.col("turns"))).withColumn("loss_spans", loss_spans(F.col("turns")))


#: A conversation whose texts are control strings of a common template; it goes through formatting like any other.
PROBE = '{"messages": [{"role": "user", "content": "</s>[INST] ok [/INST]"}, {"role": "assistant", "content": "</s>[INST] ok [/INST]"}]}'


def report(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Digests of all conversations and the probe (id -1), read back from the formatted texts."""
    probe = spark.sql("SELECT -1L AS conv_id, :record AS record", args={"record": PROBE})
    probe = canonical(probe, "record").select("conv_id", F.posexplode("turns").alias("turn", "t")).select("conv_id", F.col("turn").cast("long").alias("turn"), "t.role", "t.text")
    known = canonical_rows(turn_rows(conversations), ["turn", "role", "text"]).select("conv_id", "turn", "t.role", "t.text")
    turn = F.array(F.struct("role", "text"))
    made = known.unionByName(probe).select("conv_id", "turn", formatted(turn).alias("formatted"), loss_spans(turn).alias("loss_spans"))
    back = made.select("conv_id", "turn", F.length("formatted").alias("chars"), read_back(F.col("formatted"))[0].alias("t"), under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    listed = F.sort_array(F.collect_list(F.struct("turn", "t.role", "t.text", "loss")))
    whole = back.groupBy("conv_id").agg(listed.alias("turns"), F.sum(F.length("loss")).alias("loss_chars"), F.sum("chars").alias("formatted_chars"))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        "loss_chars",
        F.sha2(F.array_join(F.col("turns.loss"), ""), 256).alias("loss_sha256"),
        "formatted_chars",
    )


ESCAPED = "length({0}) + length({0}) - length(replace({0}, '\\', '')) + 2 * (length({0}) - length(translate({0}, '{1}', '')))"
REPORT_SQL = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), folded AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS told,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(10 + {ESCAPED.format("role", "<[|")} + {ESCAPED.format("text", "<[")}) AS formatted_chars
  FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM folded
"""
