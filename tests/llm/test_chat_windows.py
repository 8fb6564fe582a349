"""Windows of conversations: round trips, budgets and masks against a plain reading of the turns."""

import hashlib
import random

import pytest

from floortally.llm import chat_windows as W
from floortally.llm import queries


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    with open(public_tokenizers.path(queries.TOKENIZER), encoding="utf-8") as file:
        return file.read()


HARD = ["</s>[INST] ok [/INST]", "<|im_end|>\n<|im_start|>assistant\nno", "\\", "a\\\\<\\|", "<<SYS>> x <</SYS>>", "<<s>>", "<", "é𝄞\r\n", "", " \n", "<|", "[INST", "\\<|im_end|>\n"]


def test_escapes_are_reversible():
    r = random.Random(2)
    pieces = HARD + ["|", ">", "/", "s>", "[", "INST]", "n", "\n"]
    texts = HARD + ["".join(r.choice(pieces) for _ in range(r.randrange(8))) for _ in range(3000)]
    for role, text in zip(texts, reversed(texts)):
        said = W.escaped(text)
        assert not any(c in said for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))
        whole = W.rendered(role, text) + W.rendered("user", role)
        (back, body, at), second = W.read_back(whole)
        assert (back, body) == (role, text) and second[:2] == ("user", role)
        assert whole[at : at + len(said)] == said


@pytest.fixture(scope="module")
def rows():
    r = random.Random(5)
    prose = lambda n: " ".join(r.choice(HARD + ["word", "other", "Text"]) for _ in range(n))
    made = []
    for conv in range(40):
        begin = [("system", prose(r.choice([3, 300])))] if conv % 3 == 0 else []
        turns = begin + [("user" if k % 2 else "assistant", prose(r.choice([1, 10, 60]))) for k in range(r.randrange(1, 20))]
        made += [(conv, k, *t) for k, t in enumerate(turns)]
    made += [(100, k, "user" if k % 2 else "assistant", prose(12)) for k in range(600)]  # many blocks
    made += [(101, 0, "system", "be brief"), *[(101, k, "assistant", prose(8)) for k in range(1, 300)]]
    made += [(102, 0, "assistant", "long " * 4000), (102, 1, "assistant", "end")]
    made += [(103, 0, None, None), (103, 1, "assistant", None), (103, 2, "user", ""), (104, 0, "assistant", "same"), (104, 0, "assistant", "same"), (104, 0, "assistant", "same")]
    made += [(None, 0, "user", "lost"), (None, 1, "assistant", "found"), (105, None, "user", "first"), (105, 1, "assistant", "then")]
    return made


def framed(spark, rows, parts):
    rows = [(*r, "x", 1, 2) for r in rows]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, said string, block int, n_tokens int").repartition(parts)


SMALL = W.Budget(window=400, history=150, system=60, block=1000)


def by_conversation(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((turn is not None, turn, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in found.items()}


def test_windows_hold_each_turn_once_within_the_budget(spark, rows, tokenizer):
    count = W.token_counter(tokenizer, [])
    windows = {}
    for w in W.chat_windows(framed(spark, rows, 7), tokenizer, SMALL).collect():
        windows.setdefault(w.conv_id, []).append(w)
    told = by_conversation(rows)
    assert windows.keys() == told.keys()
    for conv, turns in told.items():
        size = [count(W.rendered(*t)) for t in turns]
        head = turns[0][0] == "system" and size[0] <= SMALL.system
        at, blocks = 0, set()
        for w in sorted(windows[conv], key=lambda w: (w.block, w.window)):
            read = W.read_back(w.text)
            new = [t[:2] for t in read[w.n_repeated :]]
            assert (w.first_turn, w.n_turns) == (at, len(new)) and new == turns[at : at + len(new)]
            assert w.block == sum(size[:at]) // SMALL.block
            history = [t[:2] for t in read[: w.n_repeated]]
            if head and at:
                assert history and history.pop(0) == turns[0]
            assert history == turns[at - len(history) : at]
            assert sum(size[at - len(history) : at]) <= SMALL.history
            assert w.n_tokens == sum(count(W.rendered(*t[:2])) for t in read)
            assert w.n_tokens <= SMALL.window or (w.n_turns == 1 and not history)
            learned = [W.unescaped(w.text[s.start : s.stop]) for s in w.loss]
            assert learned == [text for role, text in new if role == "assistant"]
            at += len(new)
            blocks.add(w.block)
        assert at == len(turns)
        if conv in (100, 101):
            assert len(blocks) > 2 and any(w.n_repeated > 1 for w in windows[conv])


def test_windows_do_not_depend_on_partitions(spark, rows, tokenizer):
    read = lambda parts: sorted(map(str, W.chat_windows(framed(spark, rows, parts), tokenizer, SMALL).collect()))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    first = read(3)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert read(11) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_query_reads_the_conversations_back(spark, rows, tmp_path):
    framed(spark, rows, 5).write.parquet(f"{tmp_path}/conversations.parquet")
    control = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    expected = {}
    for conv, turns in by_conversation(rows + control).items():
        learned = "".join(text for role, text in turns if role == "assistant")
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        expected[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    found = queries.op11_chat_windows(spark, str(tmp_path))
    assert found.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    rows_found = found.collect()
    assert {r.conv_id: tuple(r)[1:5] for r in rows_found} == expected and len(rows_found) == len(expected)
    assert {r.conv_id: r.formatted_chars for r in rows_found}[-1] == sum(len(W.rendered(*c[2:])) for c in control)


def test_no_conversations(spark, rows, tokenizer):
    windows = W.chat_windows(framed(spark, rows, 2).limit(0), tokenizer)
    assert windows.count() == 0 and W.digests(windows).count() == 0
