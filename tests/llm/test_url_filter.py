import random

import numpy as np
import xxhash

from tablescope.llm import url_filter as U

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in rules:
        own, slash, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith(slash + start):
            best = max(best or (0,), (len(rule), len(own), verdict == "block", rule))
    return host, path, best and best[3], ("block" if best[2] else "allow") if best else default


def found(spark, urls, rules, **more):
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string")
    return {r.page_id: tuple(r)[1:] for r in U.judge_urls(pages, rules, **more).collect()}


def test_urls(spark):
    urls = ["http://a.example.net/en/1", "https://EXAMPLE.Net/en", "http://net/x", "http://net", "http://x.net?/en/", "ftp://planet/",
            "http://example.com/de/1?q=://a", "http://b.org/fr/#x", "http://org/fr", None, "", "no scheme/net/", "://", ":///en/",
            "http://u@h.net:80/x", "http://example.net./en/", "http://ünï.net/é/ß", "http://a.net/" + "x" * 50_000]
    got = found(spark, urls, RULES)
    assert got == {i: brute(u, RULES) for i, u in enumerate(urls)}


def test_many_rules_in_many_files(spark, monkeypatch):
    monkeypatch.setattr(U, "FILE_RULES", 7)
    rnd = random.Random(2)
    name = lambda: rnd.choice("abc") + rnd.choice(["", "d"])
    host = lambda: ".".join(name() for _ in range(rnd.randint(1, 3)))
    path = lambda: "/" + "".join(rnd.choice("xy/") for _ in range(rnd.randint(0, 3)))
    rules = list({host() + path(): rnd.choice(["block", "allow"]) for _ in range(60)}.items())
    urls = [f"http://{host()}{path()}" for _ in range(800)]
    assert found(spark, urls, rules, default="block") == {i: brute(u, rules, "block") for i, u in enumerate(urls)}


def test_no_rules_and_no_pages(spark):
    assert found(spark, ["http://a.net/"], []) == {0: ("a.net", "/", None, "allow")}
    pages = spark.createDataFrame([], "page_id long, url string")
    assert U.judge_urls(pages, RULES).count() == 0


def test_a_collision_is_confirmed_by_the_string(tmp_path):
    raw = bytearray(U._file_of([("a/", "block"), ("b/", "allow")]))
    same = np.array([77, 77], dtype="<u8").tobytes()
    raw[32:48] = same  # both keys equal
    file = tmp_path / "rules.bin"
    file.write_bytes(raw)
    d = U.DigestFile(str(file))
    texts = [b"a/", b"b/", b"c/"]
    places = d.find(np.array([77, 77, 77], dtype="<u8"), texts)
    assert places[2] == -1 and sorted(places[:2]) == [0, 1]
    stored = [d.strings[d.offsets[p]: d.offsets[p + 1]].tobytes() for p in places[:2]]
    assert stored == texts[:2]
    assert d.find(np.array([xxhash.xxh64_intdigest(b"a/")], dtype="<u8"), [b"a/"])[0] == -1


def test_long_hosts_cost_no_more_than_the_rules(spark):
    """A host of a million labels: only suffixes that some rule could equal are probed."""
    rules = [("example.net/", "block"), ("b.example.net/x/", "allow"), ("net/", "allow")]
    long = "a." * 500_000 + "b.example.net"
    assert len(list(U._suffixes(long, len("b.example.net")))) == 3
    assert list(U._suffixes("b.example.net", 13)) == ["net", "example.net", "b.example.net"]
    assert list(U._suffixes("", 5)) == [""] and list(U._suffixes("x", 0)) == []
    assert list(U._suffixes("a..b", 3)) == ["b", ".b"]
    rows = [(1, f"http://{long}/x/1"), (2, f"http://{long}/y"), (3, "http://" + "z" * 1_000_000 + "/"), (4, "http://" + "." * 1_000_000 + "net/")]
    got = U.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules)
    assert sorted((r.page_id, r.rule) for r in got.collect()) == [(1, "b.example.net/x/"), (2, "example.net/"), (3, None), (4, "net/")]


def test_probes_are_searched_in_parts(spark, monkeypatch):
    rules = [(f"h{i}.org/", "block") for i in range(50)]
    names = ["f"]
    monkeypatch.setattr(U, "PROBES", 3)
    monkeypatch.setattr(U.SparkFiles, "get", lambda name: path)
    import pyarrow as pa
    import tempfile
    with tempfile.NamedTemporaryFile(suffix=".bin") as f:
        f.write(U._file_of(rules))
        f.flush()
        path = f.name
        batch = pa.RecordBatch.from_pydict({"id": list(range(60)), "host": [f"x.h{i}.org" for i in range(60)], "path": ["/"] * 60})
        out = next(U._judge(names, "allow")(iter([batch])))
    assert out.column("rule").to_pylist() == [f"h{i}.org/" if i < 50 else None for i in range(60)]
