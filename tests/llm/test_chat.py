import hashlib

import pytest
from pyspark.sql import functions as F

import check
from tradevault.llm import chat as C

ROWS = "conv_id long, turn long, role string, text string"
CONTROL = ["</s>", "<|user|>\n", "[INST]", "\\", "\\.", "<\\.", "<", "|>", "é😀", "\n", "", "<|", "[/INST]\\"]


def test_equals_its_sql(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    problem, n = check.compare(C.report(spark, rows), check.connect(sf), C.REPORT_SQL)
    assert problem is None and n > 1


def test_round_trip_of_control_strings(spark):
    rows = [(i, j, r, a + b + c) for i, a in enumerate(CONTROL) for j, (b, c) in enumerate(zip(CONTROL, CONTROL[3:])) for r in (["user", "assistant", "a|>\n<b"][j % 3],)]
    made = C.format_records(C.conversation_records(spark.createDataFrame(rows, ROWS)))
    got = made.select("conv_id", "formatted", C.read_back(F.col("formatted")).alias("turns"), C.under_mask(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    for r in got:
        want = [(x[2], x[3]) for x in sorted(rows) if x[0] == r["conv_id"]]
        assert [tuple(t) for t in r["turns"]] == want
        assert r["loss"] == "".join(t for role, t in want if role == "assistant")
        assert r["formatted"].count("</s>") == len(want) and "[INST]" not in r["formatted"]


LAYOUTS = [
    ('{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}', "messages", [("user", "q"), ("assistant", "a")]),
    ('{"messages":[{"content":null,"role":"user"}]}', "messages", [("user", "")]),
    ('{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}', "speakers", [("user", "q"), ("assistant", "a")]),
    ('{"prompt":"q","completion":"a"}', "prompt", [("user", "q"), ("assistant", "a")]),
    ('{"question":"q","answer":"a","system":"s"}', "question", [("system", "s"), ("user", "q"), ("assistant", "a")]),
    ('{"instruction":"q","input":"x","output":3}', "instruction", [("user", "q\nx"), ("assistant", "3")]),
    ('{"output":"a","instruction":"q"}', "instruction_only", [("user", "q"), ("assistant", "a")]),
    ('{"prompt":"q","completion":"a","more":1}', None, None),
    ('{"messages":[]}', None, None),
    ("no json", None, None),
    (None, None, None),
]


def test_layouts(spark):
    records = spark.createDataFrame([(i, r) for i, (r, _, _) in enumerate(LAYOUTS)], "i int, record string").withColumn("turns", F.lit("clash")).withColumn("layout", F.lit(0))
    got = {r["i"]: r for r in C.format_records(records).collect()}
    for i, (_, layout, turns) in enumerate(LAYOUTS):
        assert got[i]["layout"] == layout
        assert (turns is None and got[i]["turns"] is None) or [tuple(t) for t in got[i]["turns"]] == turns


def test_fingerprints_follow_paths_not_types(spark):
    records = spark.createDataFrame([('{"a":1,"b":{"c":[{"d":"x"}]}}',), ('{"b":{"c":[{"d":null}]},"a":"1"}',), ('{"a":1,"b":{"c":{"d":"x"}}}',)], "r string")
    got = [r[0] for r in records.select(C.fingerprint(F.parse_json("r"))).collect()]
    assert got[0] == got[1] != got[2]


def test_odd_rows(spark):
    rows = spark.createDataFrame([(None, None, None, None), (1, 2, "assistant", "b"), (1, None, "user", None), (1, 2, "assistant", "b"), (1, 2, "assistant", "a")], ROWS).withColumn("record", F.lit(1)).withColumn("formatted", F.lit(1))
    got = {r["conv_id"]: r for r in C.report(spark, rows).collect()}
    assert set(got) == {None, -1, 1}
    assert got[1]["n_turns"] == 4 and got[1]["loss_sha256"] == hashlib.sha256(b"abb").hexdigest() and got[1]["loss_chars"] == 3
    assert got[None]["turns_sha256"] == hashlib.sha256(b"\n\n").hexdigest()
    assert C.report(spark, rows.limit(0)).count() == 1


def test_conversation_beyond_a_variant(spark):
    """130 MiB in one conversation: more than a JSON record may have."""
    n, size = 130, 1 << 20
    rows = spark.range(n).select(F.lit(None).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.repeat(F.lit("<"), size).alias("text"))
    got = {r["conv_id"]: r for r in C.report(spark, rows).collect()}[None]
    assert (got["n_turns"], got["loss_chars"]) == (n, n * size)
    assert got["formatted_chars"] == n * (len("<|assistant|>\n") + 3 * size + len("</s>\n"))
    want = hashlib.sha256()
    for _ in range(n):
        want.update(b"<" * size)
    assert got["loss_sha256"] == want.hexdigest()


def test_turn_rows_of_several_layouts(spark):
    """The fingerprint of the columns chooses the mapping; an unknown layout keeps its fingerprint and has no turn."""
    one = spark.createDataFrame([(1, "user", "q"), (2, None, None)], "turn int, role string, text string")
    two = spark.createDataFrame([(1, "gpt", "a")], "turn int, `from` string, value string")
    odd = spark.createDataFrame([("user", "q", 1)], "role string, text string, extra int").withColumn("t", F.lit("clash"))
    got = [C.canonical_rows(one, ["turn", "role", "text"]), C.canonical_rows(two, ["turn", "from", "value"]), C.canonical_rows(odd, ["role", "text", "extra"])]
    rows = [[(r["layout"], r["t"] and tuple(r["t"])) for r in x.collect()] for x in got]
    assert rows == [[("turn_rows", ("user", "q")), ("turn_rows", ("", ""))], [("speaker_rows", ("assistant", "a"))], [(None, None)]]
    assert all(r["fingerprint"] is not None for x in got for r in x.collect())


def test_rows_are_mapped_by_their_fingerprint(spark, sf):
    plan = C.report(spark, spark.read.parquet(f"{sf}/conversations.parquet"))._jdf.queryExecution().optimizedPlan().toString()
    assert "SchemaOfVariant" in plan and "to_variant_object" in plan
