import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, pos int, parts string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "clash") for r in rows], SCHEMA)


def expected(turns):
    turns = [(r or "", t or "") for _, r, t in sorted(turns, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or "", x[2] or ""))]
    loss = "".join(t for r, t in turns if r == "assistant")
    return (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


def check(spark, rows):
    got = {r["conv_id"]: tuple(r)[1:5] for r in C.read_back(C.format_examples(frame(spark, rows))).collect()}
    by = {}
    for c, *t in rows:
        by.setdefault(c, []).append(t)
    assert got == {c: expected(t) for c, t in by.items()}


def test_nulls_ties_repeats_and_order(spark):
    check(spark, [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 2, "user", "tail"), (2, 0, "user", "only"), (None, 0, "assistant", ""),
                  (3, 0, None, "x\ny"), (3, 0, None, "x\ny"), (3, None, "assistant", "é😀"), (4, 0, "a\nb%0A%25", "r"), (4, 1, "<|im_end|>", "q")])


def test_empty_table(spark):
    assert C.read_back(C.format_examples(frame(spark, []))).count() == 0


def test_long_text(spark):
    check(spark, [(1, 0, "user", "ab </s> " * 50_000), (1, 1, "assistant", "[INST]" * 20_000)])


def test_probe_masks_only_the_reply(spark):
    ex = C.format_examples(C.with_probe(frame(spark, []))).collect()
    assert len(ex) == 1
    text, s, e = ex[0]["text"], ex[0]["loss_start"], ex[0]["loss_end"]
    assert C.PROBE_TEXT not in text and text[s:e].replace("\\", "") == C.PROBE_TEXT


def test_one_example_per_reply_with_all_context(spark):
    ex = C.format_examples(frame(spark, [(1, i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(7)])).orderBy("target_turn").collect()
    assert [r["target_turn"] for r in ex] == [1, 3, 5, 6]
    for r in ex[:3]:
        assert r["text"][r["loss_start"]:r["loss_end"]] == f"t{r['target_turn']}"
        assert all(f"\nt{i}<" in r["text"] for i in range(r["target_turn"] + 1))
    assert ex[3]["loss_start"] is None


PIECES = ["<|im_start|>", "<|im_end|>", "\n", "\\", "<", "[", "</s>", "<s>", "[INST]", "[/INST]", "<\\/s>", "[\\\\INST]", "|im_end|>", "s>", "a", "%", "0A", "é", "<<SYS>>"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.lists(st.sampled_from(PIECES), max_size=9), st.lists(st.sampled_from(PIECES), max_size=4)), min_size=20, max_size=40))
def test_round_trip(spark, rows):
    check(spark, [(i // 3, i % 3, "assistant" if i % 3 == 1 else "".join(r), "".join(t)) for i, (t, r) in enumerate(rows)])
