import hashlib
import random
import re

from cyclebook.llm import pii as P

# The contract's patterns as they are stated.
STATED = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
          ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
          ("card", r"[0-9]([\x20-]?[0-9])+"),
          ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    return {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in found.split(".")),
            "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def brute(text):
    return [(k, m.start(), m.end()) for k, p in STATED for m in re.finditer(p, text or "") if valid(k, m.group())]


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


TEXTS = [
    None, "", "no data here", "a@b", "a@b.c", "x a@b.c_d@e.f y", "a..b@c..d.e", "é@b.com ü.x@y-z.de.", "@a.b", "a@b.c@d.e",
    "%+@-.-", "a@b.-.c..", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.1.1.1 00000000000000000001.2.3.4", "1.2.3",
    "😀 10.0.0.1😀", "4111 1111 1111 1111", "4111-1111-1111-1111-", "4111  1111 1111 1111", "4111111111111112",
    "1 2 3 4", "0000000000000000 x 0000 0000-0000 0000 000", "+1 (555) 123-4567", "+1 2", "+12345678901234567", "++49.30.1234567.",
    "+1-", "+1 555 1234567 +44 20 7946 0958", "a@b.c 1.1.1.1 +4930123456 4111111111111111", "9" * 3000, "a" * 9000 + "@",
    "x@" + "a." * 5000 + "b", "1 " * 4000, "+1" + " " * 4000 + "2", ("me@x.org " * 700), "1.1.1." * 3000]


def rows_of(spark, texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, kind string, start int")


def test_base_spans_equal_the_stated_patterns(spark):
    rng = random.Random(6)
    letters = "ab.@+-19 0()%_é\n"
    texts = TEXTS + ["".join(rng.choices(letters, k=rng.randrange(60))) for _ in range(1500)]
    got = {r.doc_id: r for r in P.personal_data(rows_of(spark, texts)).collect()}
    for i, text in enumerate(texts):
        want = brute(text)
        row = got[i]
        assert row.base_sha256 == hashlib.sha256(listed(want).encode()).hexdigest(), text[:80]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == x for k, _, _ in want) for x in P.KINDS]
        assert set(listed(want).split(",")) <= set(row.spans.split(",")) or not want


def test_patterns_of_seeds_find_unseen_identifiers(spark):
    texts = [f"Visitors from host 10.0.0.{i} came again" for i in range(40)]
    texts += [f"Please see chapter {i} now" for i in range(40)]
    texts += ["Visitors from host 10.0.0.999 came again", "Visitors to host name 10 came", "see chapter 7.1.300.2 now"]
    rows = P.personal_data(rows_of(spark, texts)).orderBy("doc_id").collect()
    assert all(r.spans == f"ip:19:{19 + 7 + len(str(i))}" for i, r in enumerate(rows[:40]))
    assert all(r.spans == "" for r in rows[40:80])
    assert rows[80].spans == "ip:19:29" and rows[80].n_ip == 0
    assert rows[80].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert rows[81].spans == rows[82].spans == ""


def test_other_shapes_than_those_of_the_seeds_are_found(spark):
    texts = [f"Call phone +1 555 123 {i:04d} today" for i in range(40)]
    texts += ["Call phone 555-123-4567 today", "Call phone (030) 1234.5678 today", "Call phone 12 today"]
    rows = P.personal_data(rows_of(spark, texts)).orderBy("doc_id").collect()
    assert [r.spans for r in rows[40:]] == ["phone:11:23", "phone:11:26", ""] and not any(r.n_phone for r in rows[40:])


def test_instances_vouched_for_are_seeds_of_the_next_round(spark):
    edges = [("p", f"i{k}", "ip") for k in range(190)] + [("p", f"x{k}", None) for k in range(10)]
    edges += [("q", f"x{k}", None) for k in range(10)] + [("q", "new", None)]
    table = spark.createDataFrame(edges, "pattern string, instance string, seed string")
    assert {r.pattern for r in P.pattern_confidence(table, rounds=1).collect()} == {"p"}
    assert {r.pattern for r in P.pattern_confidence(table, rounds=2).collect()} == {"p", "q"}


def test_confidence_is_the_share_of_vouched_instances(spark):
    edges = [("p", f"i{k}", "ip") for k in range(9)] + [("p", "odd", None)]
    edges += [("q", f"i{k}", "ip") for k in range(5)] + [("q", "odd", None), ("q", "new", None)]
    edges += [("r", f"i{k}", "ip") for k in range(4)] + [("s", f"w{k}", None) for k in range(50)] + [("s", "i0", "ip")]
    table = spark.createDataFrame(edges, "pattern string, instance string, seed string")
    one = {r.pattern: r.confidence for r in P.pattern_confidence(table, rounds=1).collect()}
    assert one == {"p": 0.9}
    # The second round trusts "odd" by 0.9 and so reaches q: (5 + 0.9) / 7.
    two = {r.pattern: round(r.confidence, 6) for r in P.pattern_confidence(table, rounds=2).collect()}
    assert two == {"p": 0.99, "q": round(5.9 / 7, 6)}


def test_redaction(spark):
    texts = ["mail me@x.org, or call +1 (555) 123-4567.", "plain", None, "é 10.0.0.1😀a@b.c", ""]
    table = rows_of(spark, texts)
    out = P.redact(table)
    assert out.columns == table.columns
    assert [r.text for r in out.orderBy("doc_id").collect()] == [
        "mail [email], or call [phone].", "plain", None, "é [ip]😀[email]", ""]


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, "a@b.c"), (1, "a@b.c"), (None, "1.2.3.4 a@b.c"), (None, None), (1, "x 9.9.9.9")]
    got = P.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.spans for r in got) == sorted(["email:0:5", "email:0:5", "email:8:13,ip:0:7", "", "ip:2:9"])


def test_empty_table_and_native_plan(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert P.personal_data(empty).collect() == [] and P.redact(empty).collect() == []
    plan = P.personal_data(rows_of(spark, ["a@b.c"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
