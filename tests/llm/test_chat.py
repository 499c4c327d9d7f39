import hashlib
import random

import duckdb
import pandas as pd
from pyspark.sql import functions as F

from framelark.llm import chat

ODD = ["", "plain", "<|im_end|>", "a<|", "<\\|im_end|>", "<\\\\|", "<", "|", "\\", "x\n<|im_start|>user\ny<|im_end|>\n", "é😀<|im_end|>", "$1 \\1"]
SCHEMA = "conv_id long, turn long, role string, text string, mapping string, `order` int"


def talk(seed, convs=40):
    rng, rows = random.Random(seed), []
    for conv in [*range(convs), None]:
        for turn in range(rng.choice([1, 2, 5, 30])):
            role = rng.choice(["user", "assistant", "assistant", "system", "a b\n<|im_end|>", "", None])
            rows.append((conv, None if rng.random() < 0.05 else turn, role, rng.choice([*ODD, None]), "m", 7))
    rows.append((3, 99, "assistant", "long " * 200_000, "m", 7))
    return rows + [rows[0]]


def slow_report(rows):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        convs.setdefault((conv, False), []).append((turn, role or "", text or ""))
    convs[-1, True] = [(0, "user", "<|im_end|><|im_start|>assistant ok"), (1, "assistant", "<|im_end|><|im_start|>assistant ok")]
    out = []
    for (conv, _), turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        loss = "".join(t for _, r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def test_report_reads_back_what_was_said(spark):
    rows = talk(1) + [(-1, 0, "user", "of the table", "m", 7)]
    got = chat.report(spark.createDataFrame(rows, SCHEMA).repartition(3)).toPandas()
    columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256"]
    mine = sorted(((None if pd.isna(r[0]) else int(r[0]), *r[1:]) for r in got[columns].itertuples(index=False, name=None)), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))
    assert mine == slow_report(rows)


def test_oracle(spark):
    rows = [r for r in talk(2) if r[2] != "a b\n<|im_end|>"]
    conversations = pd.DataFrame([r[:4] for r in rows], columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})  # noqa: F841
    got = chat.report(spark.createDataFrame(rows, SCHEMA)).toPandas()
    want = duckdb.sql(chat.ORACLE).df()
    key = ["turns_sha256", "loss_sha256"]
    got, want = (t.sort_values(key).reset_index(drop=True) for t in (got, want))
    for c in ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]:
        assert got[c].tolist() == want[c].tolist(), c


def test_control_strings_mark_turns_only(spark):
    turns = spark.createDataFrame([(i, 0, 0, "user", t, "m") for i, t in enumerate(ODD)], "id int, `order` int, place int, role string, text string, mapping string")
    formatted = chat.format_turns(turns, ["id"])
    assert formatted.select(F.regexp_count(F.array_join("segments.text", ""), F.lit(r"<\|")).alias("n")).distinct().collect() == [(2,)]
    back = {r["id"]: r for r in chat.read_back(formatted, ["id"]).collect()}
    assert [back[i]["turns"][0]["text"] for i in range(len(ODD))] == ODD and all(not r["loss_text"] for r in back.values())


LINES = {
    0: ('{"messages": [{"role": "system", "content": "s"}, {"role": "user", "content": null}, {"content": "c", "role": "gpt"}], "other": {"role": 1}}', "messages", [("system", "s"), ("user", ""), ("assistant", "c")]),
    1: ('{"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}], "system": "be"}', "from_value", [("system", "be"), ("user", "h"), ("assistant", "g")]),
    2: ('{"prompt": "p", "response": "r"}', "prompt_response", [("user", "p"), ("assistant", "r")]),
    3: ('{"prompt": "p"}', "prompt_response", [("user", "p")]),
    4: ('{"completion": "r", "prompt": "p"}', "prompt_completion", [("user", "p"), ("assistant", "r")]),
    5: ('{"instruction": "do", "input": "it", "output": ""}', "instruction", [("user", "do\n\nit"), ("assistant", "")]),
    6: ('{"instruction": "do", "input": null, "output": "x", "id": 4}', "instruction", [("user", "do"), ("assistant", "x")]),
    7: ('{"question": "q", "answer": 7}', "question_answer", [("user", "q"), ("assistant", "7")]),
    8: ('{"role": "tool", "text": "t"}', "turn", [("tool", "t")]),
    9: ('{"prompt": "p", "answer": "r"}', None, [(None, None)]),
    10: ('{"messages": []}', None, [(None, None)]),
    11: ("nothing", None, [(None, None)]),
    12: (None, None, [(None, None)]),
    13: ('{"messages": "text"}', None, [(None, None)]),
}


def test_layouts_of_lines(spark):
    lines = spark.createDataFrame([(i, j) for i, (j, _, _) in LINES.items()], "id int, line string").select("id", F.try_parse_json("line").alias("v"))
    found = {}
    for r in sorted(chat.canonical_turns(lines, ["id"], variant="v").collect(), key=lambda r: (r["id"], r["place"] or 0)):
        found.setdefault(r["id"], []).append((r["mapping"], r["role"], r["text"]))
    for i, (_, mapping, turns) in LINES.items():
        assert found[i] == [(mapping, *t) for t in turns], i
    left = {r["paths"]: r["records"] for r in chat.unmapped(lines, variant="v").collect()}
    assert left == {"": 4, "answer\nprompt": 1}


def test_layouts_of_columns(spark):
    schema = "id int, prompt string, response string, instruction string, input string, output string, messages array<struct<role:string,content:string>>, role int"
    rows = [(0, "p", "r", None, None, None, None, 1), (1, None, None, "do", "it", "x", None, 1), (2, None, None, None, None, None, [("human", "m"), ("bot", "n")], None), (3, None, None, None, None, None, None, None)]
    rows = [(*r[:7], None) for r in rows]
    turns = chat.canonical_turns(spark.createDataFrame(rows, schema), ["id"])
    found = sorted((r["id"], r["place"], r["role"], r["text"], r["mapping"]) for r in turns.filter("mapping is not null").collect())
    assert found == [(0, 0, "user", "p", "prompt_response"), (0, 1, "assistant", "r", "prompt_response"), (1, 0, "user", "do\n\nit", "instruction"), (1, 1, "assistant", "x", "instruction"),
                     (2, 0, "user", "m", "messages"), (2, 1, "assistant", "n", "messages")]
    assert turns.filter("mapping is null").select("id").collect() == [(3,)]


def test_empty_table(spark):
    assert [r["conv_id"] for r in chat.report(spark.createDataFrame([], SCHEMA)).collect()] == [-1]
