import hashlib
import random
import re

from riskloom.llm.pii import BASE, find_spans, is_base, luhn, mod97, personal_data, redact

# The base patterns as they are written down, with plain validators.
PATTERNS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda s: 16 <= len(d := re.sub("[ -]", "", s)) <= 19 and plain_luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 8 <= sum(c.isdigit() for c in s) <= 15),
}


def plain_luhn(digits):
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute(text):
    return [(k, *m.span()) for k, (p, ok) in PATTERNS.items() for m in re.finditer(p, text) if ok(m.group())]


def base_of(text):
    return [x[:3] for x in find_spans(text) if is_base(x[0], text[x[1] : x[2]])]


def test_base_is_what_the_patterns_say():
    rng = random.Random(3)
    pieces = [*"@.-+ ()1234567890abZé%", "a@b.c", "@d.e", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111",
              "+1 (555) 010-9999", "007.08.0.1", "\n", "mail", "x", "00", "4222222222222"]
    for _ in range(30_000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
        assert base_of(text) == brute(text), repr(text)


def test_added_kinds():
    kinds = lambda t: [(k, t[a:b]) for k, a, b, _ in find_spans(t)]
    assert kinds("pay GB82 WEST 1234 5698 7654 32 AND MORE") == [("iban", "GB82 WEST 1234 5698 7654 32")]
    assert kinds("GB83 WEST 1234 5698 7654 32") == [] and mod97("DE89370400440532013000")
    assert kinds("his ssn is 123-45-6789") == [("ssn", "123-45-6789")] and kinds("part 123-45-6789") == []
    assert kinds("card 378282246310005") == [("card", "378282246310005")] and kinds("no 378282246310005") == []
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_whole_small_table(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    want = {}
    for r in docs.collect():
        spans = brute(r.text)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        want[r.doc_id] = (*(sum(k == x[0] for x in spans) for k in BASE), digest)
    assert {r.doc_id: (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in personal_data(docs).collect()} == want


def test_edges(spark):
    rows = [(1, None, "x"), (None, "", "y"), (1, "write a.b@c.de now", "z"), (2, "9" * 500_000 + "a" * 500_000 + "@" * 100_000, ""), (3, "🎉 x@y.zz", "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = personal_data(docs).collect()
    assert sorted(((r.doc_id, r.spans) for r in got), key=repr) == sorted([(1, ""), (None, ""), (1, "email:6:14"), (2, ""), (3, "email:2:8")], key=repr)
    assert {(r.text, r.spans) for r in redact(docs.filter("doc_id = 1")).collect()} == {(None, "x"), ("write <email> now", "z")}
    assert redact(docs.limit(0)).count() == personal_data(docs.limit(0)).count() == 0
