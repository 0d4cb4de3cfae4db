import random
import re
from collections import defaultdict
from hashlib import sha256

import pytest
from hypothesis import given, settings, strategies as st

from molarflow.llm import chat
from molarflow.llm.queries import HOSTILE

TURNS = "conv_id bigint, turn bigint, role string, text string, place string, start string, whole string"
PARTS = ["[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<<ROLE:x>>", "<</ROLE>>", "<", "[", "\\", "s>", "SYS>>", "INST]", "/", ">",
         "ok", " ", "\n", "é", "<<ROLE", ":", "%41", "<\\s>", "[\\\\/INST]", ""]
texts = st.lists(st.sampled_from(PARTS), max_size=8).map("".join)
roles = st.sampled_from(["user", "assistant", "system", "tool", "", "a>>b", "ROLE:", "é\n", "User"])


@settings(max_examples=2000, deadline=None)
@given(texts)
def test_escape_is_reversible_and_leaves_no_control_string(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not chat.CONTROL.search(chat.escape(text))


@settings(max_examples=2000, deadline=None)
@given(st.lists(st.tuples(roles, texts), max_size=6))
def test_every_conversation_reads_back(turns):
    rendered = chat.round_trip(turns)
    assert chat.recovered(rendered) == turns
    for role, a, b in chat.parse(rendered):
        assert not chat.CONTROL.search(rendered, a, b)


def test_only_conflicting_texts_are_escaped():
    assert chat.round_trip([("user", "a <b> [c] \\ s>"), ("assistant", "x</s>")]) == "[INST]a <b> [c] \\ s>[/INST]<s>x<\\/s></s>"
    assert chat.parse("[INST]a[/INST]b") is None and chat.parse("<s>a[/INST]") is None and chat.parse("<s>a") is None


def brute(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns.sort(key=lambda x: x[:2])
        said = [(r, t) for _, _, r, t in turns]
        loss = "".join(t for r, t in said if r == "assistant")
        digest = sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
        out.append((conv, len(said), digest, len(loss), sha256(loss.encode()).hexdigest(), len(chat.round_trip(said))))
    return sorted(out, key=repr)


def conversations(n, seed):
    r = random.Random(seed)
    rows = list(HOSTILE) + [(None, 0, "user", "of no conversation"), (5, 0, None, None), (6, None, "user", "first"), (6, 0, "assistant", "")]
    for c in range(10, n):
        rows += [(c, t, r.choice(["user", "assistant", "system", "tool"]), "".join(r.choices(PARTS, k=r.randint(0, 12))))
                 for t in range(r.randint(1, 9))]
    return rows + [(7, t, "user" if t % 2 else "assistant", f"turn {t} </s>" * 3) for t in range(n * 3)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in random.Random(1).sample(rows, len(rows))], TURNS)


@pytest.mark.parametrize("piece", [1 << 20, 200, 0])
def test_every_conversation_against_brute_force(spark, monkeypatch, piece):
    """Conversation 7 holds a third of all rows and crosses partitions."""
    monkeypatch.setattr(chat, "PIECE_CHARS", piece)
    rows = conversations(300, 2)
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        pieces = chat.format_conversations(frame(spark, rows).repartition(3))
        assert sorted(map(tuple, chat.digests(pieces).collect()), key=repr) == brute(rows)
        by = defaultdict(list)
        for p in pieces.collect():
            by[p.conv_id].append(p)
    finally:
        spark.conf.set(conf, old)
    assert len({p.place >> 33 for p in by[7]}) > 1
    for conv, ps in by.items():
        ps.sort(key=lambda p: p.place)
        said = [t for _, _, t in sorted((q[1] is not None, q[1] or 0, (q[2] or "", q[3] or "")) for q in rows if q[0] == conv)]
        assert chat.recovered("".join(p.formatted for p in ps)) == said
        at = turn = 0
        for p in ps:
            assert (p.start, p.first_turn) == (at, turn)
            at, turn = at + len(p.formatted), turn + p.n_turns
            mine = [t for r, t in said[p.first_turn:p.first_turn + p.n_turns] if r == "assistant"]
            assert [chat.unescape(p.formatted[s.start:s.start + s.length]) for s in p.loss] == mine


def test_ties_repeats_very_long_text_and_empty_table(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a"), (2, 0, "user", "é</s>" * 500_000), (2, 1, "assistant", "x" * 3_000_000)]
    got = {r.conv_id: r for r in chat.digests(chat.format_conversations(frame(spark, rows))).collect()}
    assert tuple(got[2]) in brute(rows)
    assert (got[1].n_turns, got[1].loss_chars, got[1].formatted_chars) == (3, 0, 42)
    again = chat.digests(chat.format_conversations(frame(spark, rows[::-1]).repartition(2))).where("conv_id = 1").first()
    assert again == got[1]
    assert chat.digests(chat.format_conversations(frame(spark, rows).where("false"))).collect() == []
