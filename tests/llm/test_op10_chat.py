import hashlib

from compare import connect, difference
from pyspark.sql import functions as F
from stagefare.llm import op10_chat
from stagefare.llm.queries import ORACLES, op10_chat_formatting

EVENTS = "conv_id long, seq long, message long, role string, kind string, text string"
NASTY = ["\\### Assistant: </turn> ok", "\\b\\h\\t\\c", "######</turn></turn>", "a \n### user: x </turn>\n", "", None, "\\", "é\U0001f600#"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_matches_sql(spark, sf_dir):
    sql = ORACLES["op10_chat_formatting"]
    assert difference(op10_chat_formatting(spark, sf_dir), connect(sf_dir), sql) is None


def test_control_strings_survive(spark):
    rows = [(k, t, role, text) for k in range(3) for t, (role, text) in enumerate((r, x) for x in NASTY for r in ("user", "assistant", "a: ### b", None))]
    rows += [(None, None, None, None), (9, 1, "user", "same"), (9, 1, "user", "same")]
    table = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, message int")
    chats = op10_chat.format_chats(table)
    parsed = {r.conv_id: r for r in op10_chat.read_back(chats).collect()}
    digest = {r.conv_id: r for r in op10_chat.digests(op10_chat.read_back(chats)).collect()}
    whole = {r.conv_id: r for r in chats.collect()}
    for conv in (0, 1, 2, 9, None):
        turns = [(role or "", text or "") for c, _, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] or -1, r[2] or "", r[3] or ""))]
        turns_in_order = [(t.role, t.text) for t in parsed[conv].turns]
        assert turns_in_order == turns
        learned = [text for role, text in turns if role == "assistant"]
        spans = [s for s in whole[conv].loss_spans if s]
        under = [whole[conv].formatted[s.start : s.end] for s in spans]
        assert [x.replace("\\t", "</turn>").replace("\\h", "###").replace("\\b", "\\") for x in under] == learned
        d = digest[conv]
        assert d.loss_chars == sum(map(len, learned)) and d.loss_sha256 == sha("".join(learned))
        assert d.turns_sha256 == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert d.formatted_chars == len(whole[conv].formatted) and d.n_turns == len(turns)


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [
        (1, 3, 1, "assistant", "delta", "lo"), (1, 2, 1, "assistant", "delta", "Hel"), (1, 1, 0, "user", "delta", "hi"),
        (1, 4, 0, "user", "edit", "hi there"), (1, 5, 1, "assistant", "regenerate", None), (1, 6, 1, "assistant", "delta", "Good "),
        (1, 7, 1, "assistant", "delta", "day"), (1, 8, 2, "user", "delta", "x"), (1, 9, 2, "user", "edit", "y"), (1, 10, 2, "user", "delta", "z"),
        (2, None, 0, None, None, "kept"), (2, None, 0, None, "odd", "too"),
    ]
    got = op10_chat.fold(spark.createDataFrame(log, EVENTS)).collect()
    assert sorted((r.conv_id, r.message, r.role, r.text) for r in got) == [
        (1, 0, "user", "hi there"), (1, 1, "assistant", "Good day"), (1, 2, "user", "yz"), (2, 0, "", "kepttoo"),
    ]


def test_a_misplaced_mask_shows(spark):
    table = spark.createDataFrame([(1, 1, "user", "ask"), (1, 2, "assistant", "\U0001f600 answer"), (1, 3, "assistant", "")], "conv_id long, turn long, role string, text string")
    chats = op10_chat.format_chats(table)
    right = op10_chat.read_back(chats).first()
    assert [t.learned for t in right.turns] == [None, "\U0001f600 answer", ""]
    for by, wanted in ((1, " answer"), (-1, " \U0001f600 answe"), (1000, "")):
        moved = F.transform("loss_spans", lambda s: F.when(s.isNotNull(), F.struct((s["start"] + by).alias("start"), (s["end"] + by).alias("end"))))
        turns = op10_chat.read_back(chats.withColumn("loss_spans", moved)).first().turns
        assert turns[1].learned == wanted and turns[1].text == "\U0001f600 answer"


def test_no_rows(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert op10_chat.digests(op10_chat.read_back(op10_chat.format_chats(empty))).collect() == []


def test_plan_has_no_python(spark, sf_dir):
    plan = op10_chat_formatting(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
