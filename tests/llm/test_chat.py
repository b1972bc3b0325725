import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablescope.llm import chat

SIGN = {"system": "S", "user": "U", "assistant": "A"}


@pytest.fixture(scope="module")
def raw(spark):
    return chat.raw_transcripts(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")).cache()


def truth(turns):
    out = defaultdict(str)
    lines = defaultdict(list)
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id, r.turn)):
        for i, line in enumerate(r.text.split("\n")):
            out[r.conv_id] += SIGN[r.role] if i == 0 else SIGN[r.role].lower()
            lines[r.conv_id].append(line)
    return out, lines


def parsed(turns, model):
    states, text = defaultdict(str), defaultdict(str)
    for r in sorted(chat.parse(turns.drop("role"), model).collect(), key=lambda r: (r.conv_id, r.segment)):
        states[r.conv_id] += r.states
        text[r.conv_id] += r.rendered
    return states, text


def test_held_out_roles(raw):
    model = chat.fit(raw.where("conv_id % 2 = 0"))
    held_out = raw.where("conv_id % 2 = 1")
    want, _ = truth(held_out)
    got, _ = parsed(held_out, model)
    right = sum(a.upper() == b.upper() for c in want for a, b in zip(want[c], got[c], strict=True))
    assert right / sum(map(len, want.values())) > 0.9


@pytest.mark.parametrize(("segment", "fan"), [(1, 2), (3, 3)])
def test_segments_give_the_viterbi_of_the_whole(raw, monkeypatch, segment, fan):
    model = chat.fit(raw)
    some = raw.where("conv_id < 40")
    _, lines = truth(some)
    one_states, one_text = parsed(some, model)
    monkeypatch.setattr(chat, "SEGMENT", segment)
    monkeypatch.setattr(chat, "FAN", fan)
    states, text = parsed(some, model)
    for c, own in lines.items():
        ways = chat.trace([model.move + e for e in model.emit(own)], 2 * len(chat.ROLES), None)
        assert states[c] == one_states[c] == "".join("SsUuAa"[a] for _, a in ways)
    assert text == one_text


def test_rendering(spark, raw):
    model = chat.fit(raw)
    rows = [(1, 0, "Instructions: Be short."), (1, 1, "Human: Hello there.\nHow are you."), (1, 2, "AI: Fine.")]
    found = chat.parse(spark.createDataFrame(rows, "conv_id long, turn long, text string"), model).collect()
    assert [r.states for r in found] == ["SUuA"]
    assert found[0].rendered == ("<|system|>\nBe short.\n<|end|>\n<|user|>\nHello there.\nHow are you.\n<|end|>\n"
                                 "<|assistant|>\nFine.\n<|end|>\n")


def test_edge_cases(spark, raw):
    model = chat.fit(raw)
    rows = [(None, 0, "User: a", "x", 1), (None, None, None, "x", 1), (2, 5, "", None, None), (2, 5, "", None, None),
            (2, -70, "User: " + "long " * 20_000, "y", 2), (3, 1000, "Q: a\n\n\nA: b", "y", 2), (2, 9000, "Bot: é😀", "y", 3)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, text string, conv string, segment long")
    found = chat.parse(frame, model).collect()
    lines = defaultdict(int)
    for r in found:
        lines[r.conv_id] += r.n_lines
        assert len(r.states) == r.n_lines
    assert lines == {None: 2, 2: 4, 3: 4}
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.parse(empty, chat.fit(empty)).count() == 0


@pytest.fixture()
def many_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("turn", [None, 7])
def test_a_conversation_at_one_position_is_cut_by_rows(spark, raw, many_tasks, turn):
    model = chat.fit(raw)
    texts = [f"User: what of {i % 50}?" if i % 3 else "AI: it is so." for i in range(600)] + [None, "a\nb"]
    rows = [(None, turn, t) for t in texts] + [(5, i, f"Q: {i}") for i in range(70)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, text string").repartition(6)
    own = chat._numbered(chat._rows(frame, "conv_id", "turn", "text"))
    assert sorted(r.number for r in own.where("conv is null").collect()) == list(range(len(texts)))
    found = chat.parse(frame, model).collect()
    assert Counter(r.conv_id for r in found) == {None: -(-len(texts) // chat.SEGMENT), 5: 2}
    assert max(r.n_lines for r in found) <= chat.SEGMENT + 1
    lines = [x for t in sorted(texts, key=lambda t: (t is not None, hashlib.sha256((t or "").encode()).hexdigest())) for x in (t or "").split("\n")]
    ways = chat.trace([model.move + e for e in model.emit(lines)], 2 * len(chat.ROLES), None)
    states = "".join(r.states for r in sorted(found, key=lambda r: r.segment) if r.conv_id is None)
    assert states == "".join("SsUuAa"[a] for _, a in ways)


def test_equal_rows_are_spread_over_tasks(spark, many_tasks):
    rows = chat._rows(spark.range(4000).selectExpr("cast(null as long) c", "cast(null as long) p", "'User: a' t"),
                      "c", "p", "t")
    sizes = [r["count"] for r in chat._in_order(chat._with_digest(rows), "conv", "pos", "dig")
             .groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 4 and max(sizes) < 2000


def test_a_sample_for_the_range_partition_holds_no_texts(spark):
    """Long texts at one position: what orders them is short."""
    rows = chat._with_digest(chat._rows(spark.range(50).selectExpr("1 c", "1 p", "repeat(cast(id as string), 100000) t"), "c", "p", "t"))
    plan = chat._in_order(rows, "conv", "pos", "dig")._jdf.queryExecution().optimizedPlan().toString()
    order = [x for x in plan.split("\n") if "RepartitionByExpression" in x][0]
    assert "dig#" in order and "text#" not in order
    numbered = chat._numbered(rows.drop("dig"))
    got = [r["text"] for r in numbered.orderBy("number").collect()]
    assert got == sorted((str(i) * 100000 for i in range(50)), key=lambda t: hashlib.sha256(t.encode()).hexdigest())


def plain_fit(turns):
    counts, before = Counter(), {}
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id, r.turn)):
        state = before.get(r.conv_id, 2 * len(chat.ROLES))
        if r.role not in chat.ROLES:
            before[r.conv_id] = None
            continue
        for i, line in enumerate(r.text.split("\n")):
            to = 2 * chat.ROLES.index(r.role) + (i > 0)
            counts.update([(to, w) for w in chat.observe(line)])
            if state is not None:
                counts[state, f"to {to}"] += 1
            state = to
        before[r.conv_id] = state
    return chat.Hmm(counts)


@pytest.mark.parametrize("turn", ["turn", "100 * turn", "turn + 64", "conv_id % 100 * 64 + turn"])
def test_fit_counts_every_move(raw, many_tasks, monkeypatch, turn):
    """Positions far apart, late beginnings, long conversations, odd roles."""
    id_col = "conv_id div 100" if "conv_id" in turn else "conv_id"
    turns = raw.where("conv_id < 300").selectExpr(f"{id_col} as conv_id", f"{turn} as turn", "text",
                                                  "if(pmod(xxhash64(text), 17) = 0, 'tool', role) as role")
    want = plain_fit(turns)
    for segment in (1, 3, 64):
        monkeypatch.setattr(chat, "SEGMENT", segment)
        got = chat.fit(turns)
        assert np.array_equal(got.move, want.move) and got.seen.keys() == want.seen.keys()
        assert all(np.array_equal(got.seen[w], want.seen[w]) for w in want.seen)
