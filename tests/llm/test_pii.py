import hashlib
import re

from narrata.llm import pii
from narrata.llm.queries import op5_pii

SF = "/root/testdata/sf0.1"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def assert_found(rows, docs):
    """Base spans by brute force; all others apart from them and in place."""
    assert len(rows) == len(docs)
    for row, (_, text) in zip(sorted(rows, key=lambda r: r.doc_id), sorted(docs), strict=True):
        base = base_spans(text)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for k, _, _ in base) for kind in PATTERNS]
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        spans = [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in row.spans.split(","))] if row.spans else []
        assert set(base) <= set(spans) and len(spans) == len(base) + row.n_added
        assert spans == sorted(spans, key=lambda s: (list(PATTERNS).index(s[0]), s[1]))
        for kind, a, b in set(spans) - set(base):
            assert 0 <= a < b <= len(text) and all(b <= x or y <= a for _, x, y in base)


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = op5_pii(spark, SF).collect()
    assert_found(rows, docs)
    assert sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows) > 300
    assert sum(r.n_added for r in rows) <= 5  # numbers that fail the check digit are no cards
    clean = {i for i, t in docs if not re.search("[0-9@]", t or "")}
    assert all(not r.spans for r in rows if r.doc_id in clean)


HARD = [
    "a@b.c_x@e.f a@b.c..d@e.f a@b x@y.z. .@a.b, a@b.c-@d.e @b.c é.x@ü.de x@a.b.", "a@b.c.d@e.f a@@b.c a%+-._@x-.y-", "1.2.3.4.5.6.7.8 1.2.3.256 0255.1.1.01 1.2.3. 4.5",
    "\U0001f600 4111 1111 1111 1111 é 4111-1111-1111-1111x 4111 1111  1111 1111 41111111111111112", "5--6 4111111111111111-4111111111111111 0000000000000",
    "+1 (017) 555-7713 +1.2 +12345678 +123456789 ++49 (0)30/123456789 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 + 1", "call (555) 123-4567 or 555-123-4567, mail me: joe [at] ex dot com joe(at)ex.com",
    None, "", "no data", "1" * 40_000, "a" * 40_000 + "@", "a@" + "b." * 20_000, "1 " * 20_000, "1." * 20_000, "+" * 5000 + "1 " * 5000, "x@y.zz " * 2000, "123.45.67.89" * 50,
    "10.0.0.1 0.0.0.0 1.2.3.000 192.168.0.1 00.1.1.1 010.020.003.0100 00256.0.0.0 0.0.0.300 1.0.0", "0" * 4000 + ".0.0." + "0" * 4000,
]


def test_hard_texts(spark):
    docs = list(enumerate(HARD)) + [(100, HARD[0]), (101, HARD[0])]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS spans", "2 AS email", "3 AS kind")
    assert_found(pii.personal_data(df).collect(), docs)
    assert pii.personal_data(df.filter("false")).collect() == []
    assert pii.personal_data(df.filter("text = 'no data'")).first().spans == ""


def test_parts_of_zeros(spark):
    df = spark.createDataFrame([(1, "ip 10.0.0.1"), (2, "0.0.0.0, 1.2.3.000"), (3, "0.0.0.256")], "doc_id long, text string")
    assert {r.doc_id: r.n_ip for r in pii.personal_data(df).collect()} == {1: 1, 2: 2, 3: 0}


def test_learns_from_votes(spark):
    texts = [f"mail or call us at a{i}@ex.com or phone +1 (555) 123-4{i:03d} now, by phone (555) 123-4{i:03d} too" for i in range(100)]
    texts += [f"please call the phone (555) 123-4{i:03d} today" for i in range(40)] + [f"order 41111111111{i:05d} was sent" for i in range(100)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.personal_data(df).collect()}
    assert all(r.n_added == 0 for i, r in rows.items() if i >= 140)
    assert all(r.n_added == 1 and "phone:22:36" in r.spans for i, r in rows.items() if 100 <= i < 140)
    spans = pii.candidates(df).selectExpr("explode(spans) s").select("s.kind", "s.votes")
    found = pii.reliabilities(spans)
    assert found[3]["yes"][4] > 0.8 and found[2]["no"][1] < 0.3


def test_failed_check_digits_stay_out(spark):
    texts = [f"pay by card 4111 1111 1111 {n:04d} now" for n in range(2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pii.personal_data(df).collect()
    assert sum(r.n_card for r in rows) == 200 and all(r.n_added == 0 for r in rows)


def test_many_matches_in_linear_time(spark):
    import time

    def seconds(n):
        df = spark.createDataFrame([(1, "".join(f"a{i % 10}@b.co " for i in range(n)))], "doc_id long, text string")
        start = time.perf_counter()
        row = pii.personal_data(df).first()
        assert row.n_email == n and row.spans.endswith(f"email:{8 * n - 8}:{8 * n - 1}")
        return time.perf_counter() - start

    few, many = seconds(2_000), seconds(12_000)
    assert many < 8 * few + 5


def test_native_plan(spark):
    plan = op5_pii(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)
