import re
from collections import defaultdict

from tablescope.llm import quality_rules as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i: i + 5])].append(i)
    covered = {p + k for places in at.values() if len(places) > 1 for p in places for k in range(5)}
    base = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(covered), base)


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def check(docs):
    got = sorted((tuple(r) for r in Q.judge(docs).select("doc_id", *COLUMNS).collect()), key=repr)
    assert got == sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=repr)


def test_measures_match_brute_force(documents):
    check(documents)


def test_edge_cases(edge_docs, no_docs):
    check(edge_docs)
    assert Q.judge(no_docs).count() == 0 and Q.keep_good(no_docs).count() == 0


def test_overlapping_and_adjacent_windows(spark):
    texts = ["a b c d e a b c d e", "a a a a a a a a", "a b c d e f a b c d e f g", "\n".join(["w x y z q"] * 3), "one"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_keep_good_returns_rows_as_they_were(edge_docs):
    kept = Q.keep_good(edge_docs)
    assert kept.columns == edge_docs.columns
    good = [r.doc_id for r in Q.judge(edge_docs).where("kept").collect()]
    assert sorted(good, key=repr) == sorted((r.doc_id for r in kept.collect()), key=repr)
    assert all(r in edge_docs.collect() for r in kept.collect())


def test_rules_reject_noise_and_keep_prose(spark):
    rows = [(0, "the ### of $$$ and *** to %%% in &&& on ||| at <<< by >>> is ### it $$$"),
            (1, "the cat sat on the mat and looked at the rain that fell on the roof of the house")]
    got = {r.doc_id: r.kept for r in Q.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: False, 1: True}


def test_no_python_in_the_plan(documents):
    plan = Q.judge(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
