import hashlib
import re
from collections import Counter
from fractions import Fraction

from tessera.llm.mixing import KEY_SEED, mix, mixed_documents
from tests.llm.conftest import odd_documents


def by_hand(rows, epochs=3):
    """``{(doc_id, size): taken}`` and targets, from (doc_id, text, source) rows."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sized = [(d, s, size(t)) for d, t, s in rows]
    sources = sorted({s for _, s, _ in sized}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for _, x, n in sized if x == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    capped = set()
    while True:
        rest = sum(total.values()) - sum(epochs * total[s] for s in capped)
        unit = Fraction(rest, max(1, sum(w for s, w in weight.items() if s not in capped)))
        more = {s for s in sources if s not in capped and weight[s] * unit > epochs * total[s]}
        if not more:
            break
        capped |= more
    target = {s: Fraction(epochs * total[s]) if s in capped else weight[s] * unit for s in sources}
    taken = Counter()
    for s in sources:
        own = sorted(((int(hashlib.md5(f"{KEY_SEED}{'null' if d is None else d}".encode())
                           .hexdigest()[:15], 16), d if d is not None else -1, n)
                      for d, x, n in sized if x == s))
        left = int(target[s])
        while left > 0 and total[s]:
            for _, d, n in own:
                got = min(n, left)
                taken[(d, s)] += got
                left -= got
    return target, taken, total


def check(table):
    rows = [(r[0], r[1], r[3]) for r in table.collect()]
    target, taken, total = by_hand(rows)
    got = mix(table).collect()
    assert len(got) == len(rows)
    mine = Counter()
    for r in got:
        mine[(r.doc_id if r.doc_id is not None else -1, r.source)] += r.taken
        assert r.source_size == total[r.source] and abs(r.target - float(target[r.source])) < 1e-9 * max(
            1, r.target)
        assert r.taken <= 3 * r.size
    assert +mine == +taken


def test_mix_by_hand(spark, docs):
    check(docs)
    check(odd_documents(spark, ["one two three", "x " * 50]))


def test_small_sources_are_capped(spark):
    rows = [(i, "w " * n, "en", s, 0) for i, (s, n) in enumerate(
        [("a", 1000), ("a", 500), ("b", 3), ("c", 2), ("c", 1), ("d", 0), (None, 7)])]
    check(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n int"))


def test_documents_of_the_mix(spark, docs):
    got = mixed_documents(docs)
    assert got.columns == docs.columns
    times = Counter(r.doc_id for r in got.collect())
    want = {r.doc_id: (r.taken, r.size) for r in mix(docs).collect()}
    for d, (taken, size) in want.items():
        whole = taken // size if size else 0
        rest = taken - whole * size
        assert times[d] == whole + (rest * 2 >= size and rest > 0), d
    odd = odd_documents(spark)
    assert mixed_documents(odd).columns == odd.columns
    assert mixed_documents(odd.limit(0)).count() == 0 == mix(odd.limit(0)).count()
