"""Chat windows read back, their budgets and their masks."""

import hashlib
import random

from pyspark.sql import functions as F

from wardline.llm import chat_format as chat


def _frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string, piece string")


def _rows(words):
    r, rows = random.Random(3), []
    for c in range(30):
        n = r.choice([1, 2, 5, 9, 60])
        for t in range(n):
            role = "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[t % 2]
            rows.append((c, t, role, words(c * 100 + t, r.choice([1, 5, 40, 200, 900])), "x", "x"))
    rows += [(90, 0, "user", r"</s>[INST] \<|turn|> \\ <\|end|>", "x", "x"), (90, 1, "assistant", "<|end|>\n<|turn|>user<|text|>\\", "x", "x")]
    rows += [(91, None, None, None, "x", "x"), (91, 2, "assistant", "", "x", "x"), (91, 2, "assistant", "", "x", "x")]
    rows += [(None, 0, "user", "whose?", "x", "x"), (92, 0, "system", "only a system turn", "x", "x")]
    return rows


def test_windows_read_back_to_all_turns_and_answers(spark, words):
    rows = _rows(words)
    got = {r.conv_id: r for r in chat.read_back(chat.windows(_frame(spark, rows))).collect()}
    by = {}
    for c, t, role, text, *_ in rows:
        by.setdefault(c, []).append((t is None, t or 0, role or "", text or ""))
    assert got.keys() == by.keys()
    for c, turns in by.items():
        turns.sort()
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        loss = "".join(text for *_, role, text in turns if role == "assistant")
        r = got[c]
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_windows_hold_their_budget_system_turn_and_history(spark, words):
    rows = _rows(words)
    made = chat.windows(_frame(spark, rows), span=300, history=100).where("conv_id < 90").collect()
    for r in made:
        turns = r.text.split(chat.TURN)[1:]
        assert len(turns) == r.n_repeated + r.n_new and r.n_new >= 1
        if r.conv_id % 3 == 0:
            assert turns[0].startswith("system")
        assert not any(turns[i].startswith("system") for i in range(1, len(turns)))
    assert any(r.n_repeated > 1 for r in made)
    assert sum(r.n_new for r in made) == sum(1 for c, *_ in rows if c is not None and c < 90)


def test_new_turns_fit_the_span_unless_alone(spark):
    rows = [(1, t, "user", "w " * (20 + 37 * t % 90), "x", "x") for t in range(400)]
    frame = _frame(spark, rows)
    made = chat.windows(frame, span=200, history=0).collect()
    for r in made:
        assert r.n_repeated == 0 and (r.n_tokens <= 200 or r.n_new == 1)


def test_escapes_are_reversible(spark):
    texts = ["\\", "\\\\<|", "<\\|", "<<|", "[INST][/INST]", "<s></s>", "<<SYS>>\\<</SYS>>", "plain", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escaped(F.col("t")).alias("e"))
    for r in rows.select("t", "e", chat.unescaped(F.col("e")).alias("u")).collect():
        assert r.u == r.t and not any(c in r.e for c in chat.CONTROL)


def test_no_rows(spark):
    assert chat.read_back(chat.windows(_frame(spark, []))).count() == 0


def test_main_path_has_no_python(spark, words):
    plan = chat.read_back(chat.windows(spark.sql("SELECT 1L conv_id, 0L turn, 'user' role, 'hi' text")))
    assert not any(w in plan._jdf.queryExecution().toString() for w in ("Python", "Arrow", "Pandas"))


def test_the_query_agrees_with_its_sql(spark, small):
    from oracle_check import compare, connect

    from wardline.llm import queries

    sql = queries.oracle_sql()["op7_chat_format"]
    assert compare(connect(small), queries.op7_chat_format(spark, small), sql) is None
