"""Hilbert shards, quality rules, personal data: against brute force, and odd rows."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import pii, quality
from tessera.llm.hilbert import curve_index, shard_rows
from tests.llm.conftest import SF_TINY, odd_documents


def test_curve_visits_every_cell_by_steps_of_one(spark):
    for n, bits in ((2, 3), (3, 2), (4, 1)):
        cells = [F.expr(f"cast((id >> {i * bits}) & {(1 << bits) - 1} as int)") for i in range(n)]
        rows = spark.range(1 << (n * bits)).select(*[c.alias(f"c{i}") for i, c in enumerate(cells)])
        rows = rows.withColumn("h", curve_index([F.col(f"c{i}") for i in range(n)], bits))
        got = rows.orderBy("h").collect()
        assert [r.h for r in got] == list(range(1 << (n * bits)))
        for a, b in zip(got, got[1:]):
            assert sum(abs(a[f"c{i}"] - b[f"c{i}"]) for i in range(n)) == 1


def test_shards_are_even_and_gapless(spark, docs):
    got = shard_rows(docs, 24).collect()
    assert len(got) == docs.count()
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(24)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    h = [r.h for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert h == sorted(h)


def test_shards_of_odd_rows(spark):
    odd = odd_documents(spark)
    got = shard_rows(odd, 3).collect()
    assert len(got) == odd.count()
    assert sorted(r.size for r in got)[:4] == [8, 8, 8, 11]
    assert shard_rows(odd.limit(0), 3).count() == 0


def words_of(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def base_by_hand(t):
    t = t or ""
    w = words_of(t)
    tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    times = Counter(tri)
    covered = {p for i, x in enumerate(tri) if times[x] > 1 for p in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if words_of(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered)


def test_quality_base_figures(spark, docs):
    labels = spark.read.parquet(f"{SF_TINY}/labels.parquet")
    odd = odd_documents(spark, ["a b c a b c", "a a a a", "x\n\nx\nx #", "a  b c\x0bd"])
    text = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for table in (docs, odd):
        own = text if table is docs else {r[0]: r[1] for r in odd.collect()}
        for r in quality.quality(table, labels).collect():
            assert base_by_hand(own[r.doc_id]) == (
                r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
            failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
            assert r.base_failed == failed and (not failed or not r.kept)
    assert quality.quality(odd.limit(0), labels).count() == 0
    assert quality.quality(odd, labels.limit(0)).count() == odd.count()


def test_quality_score_by_hand(spark):
    good = [f"plain words number {i} of the good kind" for i in range(20)]
    bad = [f"@@ ## {i} $$ spam !!" for i in range(20)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    weights = quality.target_weights(docs, labels)
    assert min(weights) == pytest.approx(math.log(quality.RAW_SHARE))
    score = {r.doc_id: r.score for r in quality.quality(docs, labels).collect()}
    assert min(score[i] for i in range(20)) > 0 > max(score[i] for i in range(20, 40))


def test_quality_separates_labelled_junk(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    kept = quality.quality(docs, labels).join(labels, "doc_id").filter("NOT base_failed").groupBy(
        "quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()
    share = {r.quality: r.kept for r in kept}
    assert share[1] > 0.99 and share[0] < 0.05


def luhn(d):
    return sum(x - 9 * (x > 9) for i, c in enumerate(reversed(d)) for x in [int(c) * (1 + i % 2)]) % 10 == 0


def spans_by_hand(t):
    t = t or ""
    out = [("email", *m.span()) for m in re.finditer(
        r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]


PII_TEXTS = ["a@b.com_x@d.org", "+1 (2) 3", "x.y@z", "1.2.3.4.5.6.7.8", "00255.1.1.1 256.1.1.1",
             "4111 1111 1111 1111 and 4111-1111-1111-1111", "😀 a@b.co 1.1.1.1 é +49 (30) 1234567-",
             "a@b..c a@b.c. a@@b.c @a.b", "a" * 2000 + "@", "1" * 2000, "1 " * 2000,
             "a@b" + ".c" * 20_000, "+1" + " " * 20_000, "1." * 2000,
             "4111111111111111 4111111111111111"]


def test_base_spans_by_hand(spark, docs):
    odd = odd_documents(spark, PII_TEXTS)
    for table in (docs, odd):
        own = Counter()
        rows = [(r[0], r[1]) for r in table.collect()]
        for doc_id, t in rows:
            b = spans_by_hand(t)
            own[(doc_id, hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in b).encode()).hexdigest(),
                 *[sum(k == x for k, _, _ in b) for x in ("email", "ip", "card", "phone")])] += 1
        got = Counter((r.doc_id, r.base_sha256, r.n_email, r.n_ip, r.n_card, r.n_phone)
                      for r in pii.pii_digest(table).collect())
        assert got == own
    assert pii.pii_digest(odd.limit(0)).count() == 0


def test_added_spans_need_their_checksum_and_context(spark):
    t = ["IBAN DE89 3704 0044 0532 0130 00.", "IBAN DE88 3704 0044 0532 0130 00.",
         "my ssn 123-45-6789", "part 123-45-6789", "4111111111111111 4111111111111111",
         'token = "24be64439e3e49cf46b2d7c90f3602a3"', "24be64439e3e49cf46b2d7c90f3602a3"]
    df = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.pii_digest(df).collect()}
    assert got == {0: "iban:5:32", 1: "", 2: "ssn:7:18", 3: "", 4: "cardgroup:0:16,cardgroup:17:33",
                   5: "secret:9:41", 6: ""}


def iban_of(country, bban):
    code = "".join(str(int(c, 36)) for c in bban + country + "00")
    return f"{country}{98 - int(code) % 97:02d}{bban}"


def test_ibans_end_where_their_country_says(spark):
    t = ["NO93 8601 1117 947", "NO9386011117947.", "BE68 5390 0754 7034 BANK", "BE68539007547034 CODE 12",
         "DE89 3704 0044 0532 0130 00 BIC COBA", "DE89 3704 0044 0532 0130 00 NO93 8601 1117 947",
         "AB12 3456 7890 1234 DE89 3704 0044 0532 0130 00", "NO93 8601 1117 948", "BE68 5390 0754 7035 BANK"]
    # one of every country, alone and in front of a word; and one of a country not listed
    by = [(n, c) for n, cs in pii.IBAN_LENGTHS.items() for c in cs.split()]
    own = [iban_of(c, ("1234567890" * 4)[:n - 4]) for n, c in by] + [iban_of("ZZ", "12345678901234")]
    t += [x + (" BANK" if x[:2] != "ZZ" else "") for x in own]
    df = spark.createDataFrame(list(enumerate(t)), "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.pii_digest(df).select(
        "doc_id", F.regexp_replace("spans", "(?:card|cardgroup|phone):[0-9]+:[0-9]+,?", "").alias("spans")).collect()}
    want = ["iban:0:18", "iban:0:15", "iban:0:19", "iban:0:16", "iban:0:27", "iban:0:27,iban:28:46",
            "iban:20:47", "", ""] + [f"iban:0:{len(x)}" for x in own]
    assert [got[i] for i in range(len(t))] == want
    masked = [r.m for r in df.filter("doc_id < 6").orderBy("doc_id").select(pii.mask(F.col("text")).alias("m")).collect()]
    assert masked == ["<IBAN>", "<IBAN>.", "<IBAN> BANK", "<IBAN> CODE 12", "<IBAN> BIC COBA", "<IBAN> <IBAN>"]


def test_mask_leaves_nothing(spark, docs):
    odd = odd_documents(spark, PII_TEXTS)
    for table in (docs, odd):
        got = pii.mask_documents(table)
        assert got.columns == table.columns and got.count() == table.count()
        assert not [t for r in got.collect() for t in [r[1]] if spans_by_hand(t)]
    clean = docs.filter("NOT text RLIKE '[0-9@]'")
    assert clean.exceptAll(pii.mask_documents(clean)).count() == 0


@pytest.mark.parametrize("name", ["op2_licenses", "op4_hilbert_shards", "op6_quality", "op10_pii"])
def test_native_plans_hold_no_python(spark, name):
    from tessera.llm.queries import QUERIES
    plan = QUERIES[name](spark, SF_TINY)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
