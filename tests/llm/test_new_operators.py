"""The filter audit, the ranked search and the archives against SQL and plain Python."""

import gzip
import hashlib
import math
import os
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import duckdb
import numpy as np
import pytest

from panelwright.llm import ball_search, filter_audit, warc
from panelwright.llm.catalog import ORACLES, QUERIES
from panelwright.llm.common import cut, new_folder
from pyspark.sql import functions as F

DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    con = duckdb.connect()
    for name in os.listdir(DIR):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{DIR}/{name}'")
    return con


@pytest.mark.parametrize("name", ["op11_posting_audit", "op12_ball_tree_search", "op13_warc_transactions"])
def test_matches_sql(name, spark, connection):
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = Counter(tuple(row[names.index(c)] for c in columns) for row in result.fetchall())
    assert Counter(tuple(row[c] for c in columns) for row in df.collect()) == want


# --- audit ----------------------------------------------------------------------------------------


def test_galloping():
    rng = random.Random(3)
    for _ in range(300):
        lists = [np.array(sorted(rng.sample(range(2000), rng.choice([0, 1, 5, 300, 1500]))), np.int64) for _ in range(rng.randrange(1, 5))]
        want = sorted(set().union(*(x.tolist() for x in lists)))
        assert filter_audit.union(lists).tolist() == want
        assert filter_audit.minus(lists[0], lists[-1]).tolist() == sorted(set(lists[0].tolist()) - set(lists[-1].tolist()))


def audited(rows, names, marks):
    """rows: [(part, set of failed filters, set of marks)]"""
    out = []
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        of_part, shapley = [], Counter()
        for order in permutations(names):
            alive = own
            for step, f in enumerate(order, 1):
                gone = [r for r in alive if f in r[1]]
                alive = [r for r in alive if f not in r[1]]
                shapley[f] += len(gone)
                fails = sum(f in r[1] for r in own)
                lost = [sum(m in r[2] for r in gone) for m in marks]
                of_part.append((part, "".join(order), step, len(alive), len(gone), fails - len(gone), sum(r[1] == {f} for r in own), *lost, f))
        out += [(*r[:-1], shapley[r[-1]]) for r in of_part]
    return Counter(out)


def test_audit_of_any_filters(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "RANGE", 7)  # parts of several pieces
    rng = random.Random(1)
    rows = [(rng.choice(["", "x", "x", "x", "y"]), {f for f in "PQR" if rng.random() < 0.4}, {"m"} if rng.random() < 0.3 else set()) for _ in range(90)]
    given = [(i // 2 if i % 5 else None, p or None, "P" in f, ("Q" in f) or None, "R" in f, "m" in m, 1, 2) for i, (p, f, m) in enumerate(rows)]
    df = spark.createDataFrame(given, "id long, part string, p boolean, q boolean, r boolean, m boolean, row_no int, piece int")
    got = filter_audit.audit(df, "part", "id", {"P": F.col("p"), "Q": F.col("q"), "R": F.col("r")}, {"m": F.col("m")}, {"m": "m_lost"})
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "m_lost", "shapley"]
    assert Counter(map(tuple, got.collect())) == audited(rows, "PQR", ["m"])
    assert filter_audit.audit(df.limit(0), "part", "id", {"P": F.col("p")}, {}).count() == 0


def test_verdicts_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 1), (6, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = filter_audit.text_verdicts(odd, labels).collect()
    raw = odd.collect()
    want = []
    for r in raw:
        text = r["text"] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        same = [x["doc_id"] for x in raw if (x["text"] or "") == text and x["doc_id"] is not None]
        fails = (
            len(words) < 50,
            100 * len(set(words)) < 65 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            bool(re.search(r"[#$%&*|]", text)),
            r["doc_id"] is not None and min(same) < r["doc_id"],
        )
        want.append((r["doc_id"], r["source"], *fails, {5: True, 6: False}.get(r["doc_id"]), {5: True, 6: True}.get(r["doc_id"])))
    key = lambda r: tuple(map(str, r))
    blank = lambda r: (*r[:7], bool(r[7]), bool(r[8]))
    assert sorted(map(blank, map(tuple, got)), key=key) == sorted(map(blank, want), key=key)
    assert filter_audit.text_verdicts(empty, labels).count() == 0


# --- search ---------------------------------------------------------------------------------------


def searched(docs, queries, k):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(i, Counter(split(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(w for _, c in held for w in c)
    out = []
    for q, text in queries:
        scores = []
        for i, c in held:
            m = 100 - 90 + 90 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in set(split(text)) if c[w])
            if s > 0:
                scores.append((-s, math.inf if i is None else i))
        out += [(q, rank, None if i == math.inf else i, -s) for rank, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


@pytest.mark.parametrize("leaf, tree, block", [(4, 1 << 19, 256), (3, 60, 2), (64, 900, 3)])
def test_search_is_exact(spark, monkeypatch, leaf, tree, block):
    monkeypatch.setattr(ball_search, "LEAF", leaf)
    monkeypatch.setattr(ball_search, "TREE", tree)
    monkeypatch.setattr(ball_search, "QUERIES", block)
    rng = random.Random(leaf)
    words = ["alpha", "Beta", "gamma", "über", "日本", "x1", "y", "z", *(f"w{i}" for i in range(60))]
    some = lambda n: " ".join(rng.choices(words, k=n, weights=range(len(words), 0, -1)))
    docs = [(rng.randrange(400), some(rng.choice([1, 5, 30, 200]))) for _ in range(260)]
    docs += [(500 + i, "alpha beta, gamma!") for i in range(40)] + [(3, "y"), (3, "y"), (None, "alpha beta gamma"), (900, None), (901, " -- "), (902, "ALPHA " * 4000)]
    queries = [(i, some(rng.choice([1, 3, 12, 40]))) for i in range(9)] + [(20, "alpha beta gamma"), (21, "nothing here"), (22, None), (23, ""), (None, "Y z y")]
    d = spark.createDataFrame([(*r, 1, "q") for r in docs], "doc_id long, text string, n int, query string").repartition(3)
    q = spark.createDataFrame([(*r, 5) for r in queries], "item_id long, text string, rank int")
    assert Counter(map(tuple, ball_search.ranked(d, q, k=10).collect())) == searched(docs, queries, 10)


def test_search_of_nothing(spark, empty, odd):
    q = spark.createDataFrame([(1, "the cat")], "item_id long, text string")
    assert ball_search.ranked(empty, q).count() == 0
    assert ball_search.ranked(odd, q.limit(0)).count() == 0
    assert ball_search.ranked(odd, q).count() > 0


def test_balls_hold_their_rows_and_prune():
    rng = np.random.default_rng(0)
    width, held = 40, []
    for k in range(800):
        group = k % 8
        at = np.sort(rng.choice(np.arange(group * 5, group * 5 + 5), 3, replace=False))
        held.append((k, 100, at.tolist(), rng.integers(1, 50, 3).tolist()))
    batch = ball_search._tree_row(held, 800, 80000, width)
    column = lambda c: np.array(batch.column(c)[0].as_py())
    rows = ball_search.Rows(*map(column, ("ids", "ptr", "at", "values")))
    nodes = {c: column(c) for c in ball_search.NODES}
    dense = np.zeros((800, width), np.int64)
    for k in range(800):
        dense[k, rows.at[rows.ptr[k] : rows.ptr[k + 1]]] = rows.values[rows.ptr[k] : rows.ptr[k + 1]]
    for node in range(len(nodes["first"])):
        span = slice(nodes["centre_ptr"][node], nodes["centre_ptr"][node + 1])
        centre = np.zeros(width, np.int64)
        centre[nodes["centre_at"][span]] = nodes["centre_values"][span]
        inside = dense[nodes["first"][node] : nodes["upto"][node]]
        assert ((inside - centre) ** 2).sum(axis=1).max() == nodes["radius2"][node]
    query = np.zeros(width, np.int64)
    query[[0, 1, 2]] = 1000, 800, 20
    best = ball_search.Best(10)
    scored = ball_search.search(rows, nodes, query, int(query @ query), best)
    want = sorted(zip((-(dense @ query)).tolist(), rows.ids.tolist(), strict=True))[:10]
    assert list(zip((-best.scores).tolist(), best.ids.tolist(), strict=True)) == want
    assert scored < 400


# --- archives -------------------------------------------------------------------------------------


def pages_of(spark):
    big = "<html>" + "q" * 1200 + "</html>"
    rows = [
        (1, "http://a.b/x?y=1#z", big), (2, "http://a.b/x y\r\nX: 1", big), (3, None, big), (3, None, big), (4, "no url", big[:40]), (5, "http://c/", big[:40]),
        (6, "http://c", None), (7, "http://ä/ü", ""), (8, "http://d/", "größe 日本 \r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 30),
        (None, "http://e/", "null id" * 300), (None, "http://f/", "null id" * 300), (9, "http://g/", "null id" * 300), (10, "http://h", "\r\n\r\n"),
    ]
    return rows, spark.createDataFrame([(*r, "t", "c") for r in rows], "page_id long, url string, html string, type string, capture string")


def test_archives_of_odd_pages(spark):
    rows, df = pages_of(spark)
    path = new_folder(spark)
    warc.write(df, path, file_bytes=4000)
    records = cut(warc.read(spark, path))
    got = records.collect()
    assert len({r["record_id"] for r in got}) == len(got) == 3 * len(rows)
    largest = defaultdict(list)
    for i, _, h in rows:
        largest[h].append(i)
    want, done = [], Counter()
    for i, u, h in rows:
        raw = (h or "").encode()
        top = max((x for x in largest[h] if x is not None), default=None)
        shared = len(raw) >= 1000 and len(largest[h]) > 1
        done[i, h] += 1
        revisit = shared and (i != top or done[i, h] > 1)
        want.append((i, u, "revisit" if revisit else "response", len(raw), hashlib.sha1(raw).hexdigest(), top if revisit else None))
    nested = cut(warc.captures(records))
    assert Counter(map(tuple, warc.resolved(nested).collect())) == Counter(want)
    payloads = Counter(bytes(r["payload"]).decode() for r in got if r["type"] == "response")
    assert payloads == Counter((h or "") for (i, u, h), w in zip(rows, want, strict=True) if w[2] == "response")
    for r in nested.collect():
        assert r["request"]["record_id"] in r["response"]["concurrent_to"] and len(r["metadata"]) == 1
    empty = new_folder(spark)
    warc.write(df.limit(0), empty)
    assert warc.captures(warc.read(spark, empty)).count() == 0


def test_other_archives(spark, tmp_path):
    def record(kind, id, block, *headers):
        lines = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{id}>", *headers, f"Content-Length: {len(block)}"]
        return ("WARC/1.0\r\n" + "\r\n".join(lines) + "\r\n\r\n").encode() + block + b"\r\n\r\n"

    http = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n\x00\xff\r\n\r\nbody"
    records = [
        record("warcinfo", "i", b"software: x"),
        # the request names the response, the metadata the request, the response nothing
        record("response", "r1", http, "Content-Type: application/http;\r\n msgtype=response"),
        record("request", "q1", b"GET / HTTP/1.1\r\n\r\n", "warc-concurrent-to: <r1>"),
        record("metadata", "m1", b"fetch: 1", "WARC-Concurrent-To: <q1>"),
        record("metadata", "m2", b"fetch: 2", "WARC-Concurrent-To: <r1>", "WARC-Concurrent-To: <q1>"),
        # a request whose response is elsewhere
        record("request", "q2", b"GET /lost HTTP/1.1\r\n\r\n", "WARC-Concurrent-To: <r9>"),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records[:3])))
    (tmp_path / "b.warc").write_bytes(b"".join(records[3:]))
    got = {r["capture"]: r for r in warc.captures(warc.read(spark, f"file://{tmp_path}")).collect()}
    assert set(got) == {"<i>", "<r1>", "<q2>"}
    r = got["<r1>"]
    assert bytes(r["response"]["payload"]) == b"\x00\xff\r\n\r\nbody" and r["response"]["http_headers"] == "HTTP/1.1 200 OK\r\nA: b"
    assert r["request"]["record_id"] == "<q1>" and [m["record_id"] for m in r["metadata"]] == ["<m1>", "<m2>"]
    assert got["<q2>"]["response"] is None and got["<q2>"]["request"]["block"].startswith("GET /lost")


@pytest.mark.parametrize("data", [b"junk", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n", b"WARC/1.1\r\nWARC-Type: x\r\n\r\nabc\r\n\r\n"])
def test_damaged_archives_are_refused(data):
    with pytest.raises(ValueError, match="where.warc"):
        list(warc.parsed(data, "where.warc"))


def test_wrong_digest_is_refused():
    head = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http\r\nWARC-Payload-Digest: sha1:" + b"0" * 40
    block = b"HTTP/1.1 200 OK\r\n\r\nabc"
    with pytest.raises(ValueError, match="digest"):
        list(warc.parsed(head + b"\r\nContent-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n", "where.warc"))
