import hashlib
import random
import re
from collections import Counter

import pytest

from tablescope.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    """The base rules, as they are stated."""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]


def test_base_rules_on_documents(documents, edge_docs):
    for docs in (documents, edge_docs):
        got = Counter((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.find(docs).collect())
        want = Counter()
        for r in docs.collect():
            spans = plain(r.text or "")
            joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
            want[(r.doc_id, *(sum(s[0] == k for s in spans) for k in pii.KINDS), hashlib.sha256(joined.encode()).hexdigest())] += 1
        assert got == want


def test_base_rules_on_random_strings():
    rnd = random.Random(2)
    parts = [*"aZ09 .-@+()%_\n:12345", "1.2.3.4", "a@b.c", "4111111111111111", "+1 (555) 555-5555", "٣", "é", "000256.1"]
    for _ in range(20_000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert pii.base_spans(text) == plain(text)


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+" * 200_000, "@" * 200_000, "9 " * 100_000):
        pii.base_spans(text)


def test_model_learns_its_table_and_spares_plain_text():
    model = pii.trained()
    for text, spans in pii.labelled_rows():
        assert sorted(pii.all_spans([text], model)[1][0]) == sorted(spans), text
    clean = ["in 1999 about 1,234 rows", "see 3.14 and 2.0.", "order 4929348385146307 went out", "at 10:30 on 2020-01-02",
             "the dot at the top", 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"']
    assert pii.all_spans(clean, model)[1] == [[]] * len(clean)


@pytest.mark.parametrize(("text", "kind", "part"), [
    ("mail bob (at) corp (dot) com please", "email", "bob (at) corp (dot) com"),
    ("now call (312) 555-0177 again", "phone", "(312) 555-0177"),
    ("pay with 4111/1111/1111/1111 today", "card", "4111/1111/1111/1111"),
    ("Des +1 (826) 555-4081 190.137.223.20 la", "phone", "+1 (826) 555-4081"),
])
def test_held_out_spans(text, kind, part):
    at = text.index(part)
    assert (kind, at, at + len(part)) in pii.all_spans([text], pii.trained())[1][0]


def test_base_spans_stay_and_added_ones_do_not_touch_them(documents):
    texts = [r.text or "" for r in documents.collect()]
    base, every = pii.all_spans(texts, pii.trained())
    for b, e in zip(base, every, strict=True):
        assert set(b) <= set(e)
        for k, s, t in set(e) - set(b):
            assert all(t <= s2 or t2 <= s for _, s2, t2 in b)


def test_redact(spark, edge_docs, no_docs):
    got = pii.redact(edge_docs)
    assert got.schema == edge_docs.schema
    rows = {r.doc_id: r for r in got.where("text like '%words without%'").collect()}
    assert "mail <EMAIL> or <PHONE> to" in rows[None].text and rows[None].n_chars == len(rows[None].text)
    untouched = [r for r in edge_docs.collect() if "a@b.co" not in (r.text or "")]
    assert Counter(map(repr, untouched)) == Counter(map(repr, got.where("text is null or text not like '%words without%'").collect()))
    assert pii.redact(no_docs).count() == 0 and pii.find(no_docs).count() == 0
    assert pii.masked("a 1.2.3.4 b", [("ip", 2, 9), ("card", 4, 10)]) == "a <IP>b"


def test_model_spans_of_a_very_long_line():
    text = "12 34 at 5 " * 20_000
    assert pii.all_spans([text], pii.trained())[0] == [plain(text)]


@pytest.mark.parametrize(("text", "part"), [
    ("write to JANE (AT) EXAMPLE (DOT) COM", "JANE (AT) EXAMPLE (DOT) COM"),
    ("MAIL BOB [AT] CORP [DOT] COM PLEASE", "BOB [AT] CORP [DOT] COM"),
    ("Reach Tom (At) Sample (Dot) Org by noon", "Tom (At) Sample (Dot) Org"),
])
def test_held_out_spans_in_capitals(text, part):
    at = text.index(part)
    assert pii.all_spans([text], pii.trained()) == ([[]], [[("email", at, at + len(part))]])


def test_capitals_without_personal_data():
    clean = ["THE DOT AT THE TOP", "WE MET AT NOON AND AT NIGHT", "The Dot At The End", "CONNECT THE DOT, THEN LOOK AT IT"]
    assert pii.all_spans(clean, pii.trained())[1] == [[]] * len(clean)


def test_long_windows_are_read_in_slices(monkeypatch):
    """The same spans whatever a slice holds, and those of the whole decoded at once."""
    rnd = random.Random(4)
    parts = ["call (415) 555-0199 now", "version 2.0.1", "card 4111.1111.1111.1111", "10.0.12.7", "anna (at) example (dot) com", "7 8 9", "x" * 30,
             "212 555 0187", "+1 (415) 555-0133", "a@b.co", "1,234,567"]
    texts = [" ".join(rnd.choice(parts) for _ in range(n)) for n in (3, 40, 400)]
    model = pii.trained()
    want = pii.all_spans(texts, model)
    assert sum(map(len, want[1])) > sum(map(len, want[0]))
    for size in (1, 2, 5, 64, 1000):
        monkeypatch.setattr(pii, "SLICE", size)
        assert pii.all_spans(texts, model) == want, size


def test_a_very_long_line_of_numbers():
    """Bounded memory: features and scores of a slice, some bytes per token."""
    import tracemalloc
    rnd = random.Random(5)
    text = " ".join(rnd.choice(["12", "345,", "6.7", "(415) 555-0199,", "8/9", "2024-11-05"]) for _ in range(300_000))
    model = pii.trained()
    tracemalloc.start()
    base, every = pii.all_spans([text], model)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(every[0]) > 10_000 and most < 60 * len(text)


def test_known_spans_are_found_by_their_starts():
    rnd = random.Random(6)
    spans = [("ip", a, a + rnd.randrange(1, 30)) for a in rnd.sample(range(1000), 60)]
    known = pii._Known(spans)
    for _ in range(2000):
        a = rnd.randrange(1040)
        b = a + rnd.randrange(1, 20)
        assert known.touch(a, b) == any(s < b and a < e for _, s, e in spans)
    assert not pii._Known([]).touch(0, 10)
