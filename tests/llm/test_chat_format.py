import hashlib
import random

from hypothesis import given
from hypothesis import strategies as st
from llm_data import with_clashes
from pyspark.sql import functions as F

from postlens.llm import chat_format as c

SCHEMA = "conv_id long, turn long, role string, text string"
PARTS = ["[INST]", "[/INST]", "</s>", "<s>", "<", "\\", "/s>", "[", "a", "\n", "<<SYS>>", "é"]


@given(st.lists(st.sampled_from(PARTS)).map("".join), st.lists(st.sampled_from(PARTS)).map("".join))
def test_turns_are_read_back(role, text):
    formatted, start, end = c.format_turn(role, text)
    assert c.parse(formatted + formatted) == [(role, text)] * 2
    assert c.unescape(formatted[start:end]) == text
    assert not c._CONTROL.search(formatted[start:end])


def expected(rows):
    conversations = {}
    for conv, turn, role, text in rows:
        conversations.setdefault(conv, []).append((turn, role or "", text or ""))
    out = {}
    for conv, turns in conversations.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[conv] = (
            len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), sum(len(c.format_turn(r, t)[0]) for _, r, t in turns),
        )
    return out


def sample():
    rng = random.Random(7)
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 6)):
            text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(3))) if turn else rng.choice(["hi", "hello"])
            rows.append((conv, turn, "user" if turn % 2 == 0 else "assistant", text))
    rows += [(100, t, r, "same") for t, r in enumerate(["system", "user", "assistant"])]
    rows += [(101, t, r, "same") for t, r in enumerate(["system", "user", "assistant"])]
    rows += [(102, 5, None, None), (102, 5, None, None), (102, None, "assistant", ""), (None, 0, "user", "x")]
    rows += [(103, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(300)]
    return rows


def test_formatting_equals_brute_force(spark):
    rows = [(k, -1 if t is None else t, r, x) for k, t, r, x in sample()]
    nulls = [(k, None if t == -1 else t, r, x) for k, t, r, x in rows]
    frame = with_clashes(spark.createDataFrame(nulls, SCHEMA).repartition(4), "path", "name", "depth", "leaf")
    got = {r[0]: tuple(r)[1:] for r in c.format_conversations(frame).collect()}
    assert got == expected(rows)


def test_packs_hold_shared_turns_once_and_intervals_cover_the_ancestors(spark):
    packs = c.pack_conversations(c.named_turns(spark.createDataFrame(sample(), SCHEMA))).collect()
    by_pack = {}
    for r in sorted(packs, key=lambda r: (r.pack, r.seq)):
        by_pack.setdefault(r.pack, []).append(r)
    for rows in by_pack.values():
        text = "".join(r.piece for r in rows if r.piece is not None)
        path = []
        seen = set()
        for r in rows:
            del path[r.depth :]
            if r.piece is None:
                continue
            assert text[r.offset : r.offset + r.length] == r.piece
            assert "".join(text[i.start : i.end] for i in r.attends) == "".join(path)
            assert r.position == sum(map(len, path))
            assert all(a.end < b.start for a, b in zip(r.attends, r.attends[1:]))
            path.append(r.piece)
            assert tuple(path) not in seen
            seen.add(tuple(path))


def test_equal_conversations_are_one_path(spark):
    rows = [(i, t, "user", f"t{t}") for i in range(50) for t in range(3)]
    packs = c.pack_conversations(c.named_turns(spark.createDataFrame(rows, SCHEMA)))
    assert packs.filter(F.col("piece").isNull()).count() == 1 and packs.count() == 4


def test_empty_table(spark):
    assert c.format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []
