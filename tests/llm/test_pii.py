import hashlib
import random
import re

from larder.llm.pii import disclosing_terms, personal_data, sanitised, span_digests
from larder.llm.pii import base_spans, keyed, plain

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    spans = []
    for no, (kind, pattern) in enumerate(PATTERNS.items()):
        spans += [(m.start(), no, m.end(), kind) for m in re.finditer(pattern, text or "") if good(kind, m[0])]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(spans)]


def texts():
    pick = random.Random(5)
    parts = ["a@b.c", "a@b.c_d@e.f", "x.y%+-z@q-1.co.uk", "@", "a@b", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "00255.1.1.001", "4111 1111 1111 1111",
             "4111-1111-1111-1112", "1234567890123", "0000 0000 0000", "+1 (864) 555-2588", "+12345678", "+49.30.1234567 ", "+1+2", "é", "😀", " ", "\n", "the", "12,34", "..", "+1 2 3 4 5 6 7 8 9 10 11 12 13"]
    out = ["".join(pick.choice(parts) + pick.choice(["", " ", "", "\n"]) for _ in range(pick.randint(0, 14))) for _ in range(400)]
    return [*out, None, "", "9" * 5000, "1-2 3" * 4000, "a@" + "b." * 5000 + "c", "+1 2(3)" * 3000, "a@b.c " * 3000, "mail " * 20_000 + "é a@b.c"]


def test_base_spans_as_brute_force(spark):
    rows = list(enumerate(texts()))
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, base string, k1 int").repartition(6)
    found = {r.doc_id: r for r in span_digests(docs).collect()}
    assert len(found) == len(rows)
    for k, t in rows:
        expected = brute(t)
        r = found[k]
        assert r.base_sha256 == hashlib.sha256(",".join(expected).encode()).hexdigest(), (t or "")[:200]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(kind) for s in expected) for kind in PATTERNS]
        assert set(expected) <= set(r.spans.split(",")) | {""}


def test_terms_that_reveal(spark):
    rows = [(k, f"word{k} Zaphod beeblebrox wrote to zb@hitch.example from here and more {k}", None) for k in range(3)]
    rows += [(10 + k, f"the and {k} here from other words and more", None) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, terms string")
    terms = {r.term for r in disclosing_terms(base_spans(keyed(plain(docs)))).collect()}
    assert {"Zaphod", "beeblebrox"} <= terms and not {"here", "from", "and", "word1", "more"} & terms
    found = personal_data(docs)
    one = found.where("doc_id = 1").first()
    assert [one.text[s.start : s.stop] for s in one.all if s.kind == 4][:2] == ["Zaphod", "beeblebrox"]
    clean = sanitised(found).where("doc_id = 1").first().text
    assert "Zaphod" not in clean and "[EMAIL]" in clean and clean.endswith("from here and more 1")
    assert all(not r.all for r in found.where("doc_id >= 10").collect())


def test_copies_are_no_evidence(spark):
    text = "a rare glorbnak writes to me@here.example today"
    docs = spark.createDataFrame([(k, text) for k in range(5)] + [(k, "other") for k in range(9, 300)] + [(None, None)], "doc_id long, text string")
    assert disclosing_terms(base_spans(keyed(plain(docs)))).count() == 0
    assert span_digests(docs.limit(0)).count() == 0
