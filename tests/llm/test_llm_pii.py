import random
import re

from pyspark.sql import functions as F

from opinara.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def base_spans(text):
    out = [
        (m.start(), k, kind, m.end())
        for k, (kind, pattern) in enumerate(BASE.items())
        for m in re.finditer(pattern, text or "")
        if passes(kind, m[0])
    ]
    return ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(out))


def test_base_spans_as_the_patterns_say(spark):
    pick = random.Random(11)
    pool = [
        "a@b.c", "x_y%z@q-r.st.uv", "@", "a@b", ".", "-", " ", "é", "🙂", "+", "1", "23", "4111 1111 1111 1111", "4111-1111-1111-1112",
        "192.168.1.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "0001.2.3.004", "+49 (30) 1234-5678", "+1", "(", ")", "_", "\n", "5500005555555559", "com",
    ]
    texts = ["".join(pick.choices(pool, k=pick.randint(0, 12))) for _ in range(1500)]
    texts += [None, "", "9" * 50_000, "1 " * 20_000, "a" * 60_000 + "@", "1.2.3.4 " * 3000, "a@b.c " * 2000, "+1((((" * 5000 + "23456789"]
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in enumerate(texts)], "doc_id int, text string, _text string, found int").repartition(4)
    base = F.filter("found", lambda x: x["rank"] < 4)
    got = {r["doc_id"]: r["spans"] for r in pii.personal_data(docs).select("doc_id", pii.span_list(base).alias("spans")).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        assert got[i] == base_spans(text), repr((text or "")[:200])


def test_checks_and_context(spark):
    texts = [
        "account DE89 3704 0044 0532 0130 00 please",  # a valid account number
        "account DE89 3704 0044 0532 0130 01 please",
        "xDE89370400440532013000",
        "her ssn is 123-45-6789.",
        "part number 123-45-6789.",
        "ssn 666-45-6789",
        "call 555-123-4567 now",
        "555-123-4567",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    kinds = {r["doc_id"]: {x["kind"] for x in r["found"] if x["rank"] > 3} for r in pii.personal_data(docs).collect()}
    assert kinds == {0: {"iban"}, 1: set(), 2: set(), 3: {"ssn"}, 4: set(), 5: set(), 6: {"tel"}, 7: set()}
    scores = {r["doc_id"]: r["found"][0]["score"] for r in pii.personal_data(docs).collect() if r["found"]}
    assert scores[0] == 1.0 and scores[3] == 0.6


def test_account_numbers_end_at_their_length(spark):
    texts = {
        "DE89370400440532013000 Please": [(0, 22)],
        "DE89 3704 0044 0532 0130 00 BIC COBADEFF": [(0, 27)],
        "pay DE89 3704 0044 0532 0130 00 2024 12": [(4, 31)],
        "DE89370400440532013000 GB29 NWBK 6016 1331 9268 19 OK": [(0, 22), (23, 50)],
        "REF AA11 DE89370400440532013000 NO93 8601 1117 947 A": [(9, 31), (32, 50)],
        "xDE89370400440532013000 FR14 2004 1010 0505 0001 3M02 606": [(24, 57)],
        "MT84MALT011000012345MTLCAST001S\nX": [(0, 31)],
        "DE89370400440532013000X DE89370400440532013001 Please": [],
    }
    docs = spark.createDataFrame(list(texts.items()), "text string, want array<struct<a: int, b: int>>").withColumn("doc_id", F.monotonically_increasing_id())
    rows = pii.personal_data(docs).join(docs, "doc_id").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert [(x["start"], x["stop"]) for x in r["found"] if x["kind"] == "iban"] == [tuple(w) for w in r["want"]], r["text"]


def test_no_rows(spark):
    assert pii.personal_data(spark.createDataFrame([], "doc_id int, text string")).collect() == []


def test_rows_that_repeat_or_have_no_id(spark):
    text = "write to a.b@c.org or +1 (555) 123-4567"
    rows = [(1, text), (1, text), (None, text), (None, None), (None, ""), (2, "nothing")]
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, found string, _text int").repartition(3)
    out = pii.personal_data(docs)
    assert out.columns == ["doc_id", "found"]
    got = sorted(((r["doc_id"], [(x["kind"], x["start"], x["stop"]) for x in r["found"]]) for r in out.collect()), key=str)
    spans = [("email", 9, 18), ("phone", 22, 39)]
    assert got == sorted([(1, spans), (1, spans), (None, spans), (None, []), (None, []), (2, [])], key=str)
    assert pii.personal_data(docs.limit(0)).count() == 0
