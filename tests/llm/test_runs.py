"""Word runs: the kernel against all intervals of small texts, the query against a scan of
all lags, worst cases, odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tessera.llm.queries import op11_word_runs, with_periods
from tessera.llm.runs import find_runs, word_runs
from tests.llm.conftest import LONG, SF_TINY, odd_documents


def by_intervals(w):
    """The definition word for word; cubic."""
    n, out = len(w), []
    for s in range(n):
        for e in range(s + 12, n + 1):
            q = next(p for p in range(1, e - s + 1) if all(w[i] == w[i + p] for i in range(s, e - p)))
            wider = (s > 0 and w[s - 1] == w[s - 1 + q]) or (e < n and w[e] == w[e - q])
            if 2 * q <= e - s and not wider:
                out.append([s, e - s, q])
    return sorted(out, key=lambda r: (r[0], r[2]))


def by_lags(w):
    """Every lag from end to end; quadratic."""
    known = {}
    codes = np.array([known.setdefault(x, len(known)) for x in w], np.int64)
    best = {}
    for p in range(1, len(w) // 2 + 1):
        same = np.concatenate([[False], codes[:-p] == codes[p:], [False]])
        edges = np.flatnonzero(same[1:] != same[:-1])
        for s, e in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if e - s + p >= max(12, 2 * p):
                best.setdefault((s, e - s + p), p)          # lags ascend: the first is smallest
    return sorted(([s, n, p] for (s, n), p in best.items()), key=lambda r: (r[0], r[2]))


def random_text(rng):
    k, n = rng.choice([1, 2, 2, 3, 5]), rng.randint(0, 40)
    t = [rng.randrange(k) for _ in range(n)]
    if rng.random() < 0.6 and n > 4:
        unit = [rng.randrange(k) for _ in range(rng.randint(1, 18))]
        t = (t[:rng.randint(0, 6)] + unit * 4)[:40] + t[:rng.randint(0, 5)]
    return t


def test_kernel_by_intervals():
    rng = random.Random(7)
    for _ in range(400):
        texts = [random_text(rng) for _ in range(rng.randint(1, 4))]
        codes = np.array([c for t in texts for c in t], np.int64)
        got = find_runs(codes, np.repeat(np.arange(len(texts)), [len(t) for t in texts])).tolist()
        want, begin = [], 0
        for t in texts:
            assert by_lags(t) == by_intervals(t)
            want += [[s + begin, n, q] for s, n, q in by_intervals(t)]
            begin += len(t)
        assert got == want, texts


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


@pytest.mark.parametrize("w", [
    [0] * 3000, [0, 1] * 1500, fibonacci(3000), [bin(i).count("1") % 2 for i in range(3000)],
    list(range(700)) * 4 + [3], ([0] * 6 + [1]) * 2 + ([0] * 6 + [1, 2]) * 150 + [0] * 50,
    [int(c) for c in "1" * 13 + "01" * 200 + "10" * 200]])
def test_kernel_by_lags(w):
    codes = np.array(w, np.int64)
    assert find_runs(codes, np.zeros(len(w), np.int64)).tolist() == by_lags(w)


def test_periodic_texts_take_no_quadratic_time():
    n = 400_000
    for w in (np.zeros(n, np.int64), np.arange(n) % 2, np.arange(n) % 40_000):
        assert len(find_runs(w, np.zeros(n, np.int64))) == 1


def rebuilt(doc_id, text):
    w = [x.decode() for x in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    return w


def expected(doc_id, text):
    w = rebuilt(doc_id, text)
    runs = by_lags(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=[None] * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_query(spark, docs):
    got = {r.doc_id: tuple(r) for r in op11_word_runs(spark, SF_TINY).collect()}
    assert len(got) == docs.count() and sum(r[1] for r in got.values()) > 20
    for r in docs.collect():
        if len(r.text or "") < 30_000:                       # the scan of all lags is quadratic
            assert got[r.doc_id] == expected(r.doc_id, r.text), r.doc_id


def test_planted_periods(spark, docs):
    odd = odd_documents(spark, ["one", "a b", "x y z " * 9, "", None] * 12)
    for table in (docs, odd):
        own = [(r[0], r[1]) for r in table.select(table.columns[0], table.columns[1]).collect()] \
            if table is docs else [(r[0], r[1]) for r in table.collect()]
        want = sorted((str(d), rebuilt(d, t)) for d, t in own)
        got = sorted((str(r.doc_id), [x.decode() for x in (r.text or "").encode().split()])
                     for r in with_periods(table).collect())
        assert got == want


def test_odd_documents(spark):
    texts = ["a " * 11, "a " * 12, "a\tb\x0bc\x0c" * 7, "é è " * 6 + "é", "a\xa0b " * 12, "A a " * 8]
    odd = odd_documents(spark, texts)
    for size in (1, 50, 200_000):                             # a block of one text, of some, of all
        got = sorted((repr(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed)
                     for r in word_runs(odd, size).collect())
        want = []
        for d, t, *_ in odd.collect():
            w = [x.decode() for x in (t or "").encode().split()]
            runs = [(1, 60_000, 3)] if t == LONG else [tuple(r) for r in by_lags(w)]
            gone = {i for s, n, q in runs for i in range(s + q, s + n)}
            want.append((repr(d), len(w), runs, " ".join(x for i, x in enumerate(w) if i not in gone)))
        assert got == sorted(want)
    assert word_runs(odd.limit(0)).count() == 0
