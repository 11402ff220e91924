"""Personal data: base spans against plain regular expressions, training, masking."""

import hashlib
import re

import numpy as np
from stayline.llm import pii, queries

from llm_cases import edge_docs, empty_docs

SF = "/root/testdata/sf0.001"
#: The base patterns as the contract gives them.
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
ODD = ["a@b.c@d.e f@@g.h x@y-.z.. .%@a.b a@b@c.d", "1.2.3.4.5.6.7.8 999.1.1.1 01.002.0003.4 1.2.3.", "+1 (743) 555-3824 9.9.9.9 +49-30-123456 ++1 2",
       "4465758382889437 4465758382889437 4111-1111-1111-1111 4111  1111", "é@ü.com josé@exämple.com", "1" * 3000, "1." * 3000, "a@" * 3000, "+(" * 3000 + "1", "", "   "]


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub(r"[^0-9]", "", m.group())
            if kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card":
                doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
                if not 13 <= len(digits) <= 19 or sum(d - 9 * (d > 9) for d in doubled) % 10:
                    continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_base_spans(spark):
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    for t in texts:
        assert sorted(pii.base_spans(t)[0], key=lambda s: (pii.KINDS.index(s[0]), s[1])) == plain_spans(t)


def test_query_digests(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op1(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r["doc_id"]])
        listed = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in base) for k in pii.KINDS]
        assert set(listed) <= set(r["spans"].split(","))


def test_classifier_adds_what_the_base_misses():
    texts = [f"word mail a{i}@mail.example.com and 10.0.{i % 200}.7 then +1 (323) 555-{i:04d} ok" for i in range(200)]
    texts += [f"two 4111111111111111 {4000 + i} id {10**15 + 7 * i} end" for i in range(50)]
    texts += ["+1 (743) 555-3824 190.1.2.3 x", "4465758382889437 4465758382889437 y"]
    counts = {}
    for t in texts:
        for k, _, _, _, v in pii.candidates(t):
            counts[pii.pattern_code(k, v)] = counts.get(pii.pattern_code(k, v), 0) + 1
    codes = sorted(counts)
    kinds, given = pii.pattern_votes(codes)
    assert [pii.pattern_code(k, v) for k, v in zip(kinds.tolist(), given.tolist())] == codes
    weight = np.array([counts[c] for c in codes], float)
    posterior = pii.estimate(kinds, given, weight)
    beta = pii.train(kinds, given, weight, posterior)
    added = lambda t: [t[a:b] for _, a, b, base in pii.spans_of(t, beta) if not base]
    assert added(texts[-2]) == ["+1 (743) 555-3824"]
    assert added(texts[-1]) == ["4465758382889437"] * 2
    assert added("nothing here, version 1.2.3, order 1234567890123456, 2024-01-02") == []


def test_candidates_inside_longer_matches():
    found = lambda t: {(pii.KINDS[k], t[a:b]) for k, a, b, _, _ in pii.candidates(t)}
    both = found("+1 (743) 555-3824 4465 7583 8288 9437")
    assert {("phone", "+1 (743) 555-3824"), ("card", "4465 7583 8288 9437")} <= both
    assert ("card", "4111 1111 1111 1111") in found("Visa 2024 4111 1111 1111 1111")
    assert ("phone", "+33 1 23 45 67 89") in found("+33 1 23 45 67 89 2024-05-01")
    long = "a.long-name" * 10
    assert ("email", f"{long}é@exämple.com") in found(f"to {long}é@exämple.com")
    assert ("email", f"{long} (at) example (dot) com") in found(f"to {long} (at) example (dot) com")


def test_classifier_adds_candidates_inside_longer_matches():
    texts = [f"card 41111111111111{i:02d} and +1 (323) 555-{i:04d} or +33 1 23 45 {i % 90 + 10} 89 ok" for i in range(100)]
    counts = {}
    for t in texts:
        for k, _, _, _, v in pii.candidates(t):
            counts[pii.pattern_code(k, v)] = counts.get(pii.pattern_code(k, v), 0) + 1
    codes = sorted(counts)
    kinds, given = pii.pattern_votes(codes)
    weight = np.array([counts[c] for c in codes], float)
    beta = pii.train(kinds, given, weight, pii.estimate(kinds, given, weight))
    added = lambda t: [t[a:b] for _, a, b, base in pii.spans_of(t, beta) if not base]
    assert added("+1 (743) 555-3824 4465 7583 8288 9437") == ["4465 7583 8288 9437", "+1 (743) 555-3824"]
    assert added("Visa 2024 4111 1111 1111 1111") == ["4111 1111 1111 1111"]
    assert added("+33 1 23 45 67 89 2024-05-01") == ["+33 1 23 45 67 89"]


def test_edge_cases_and_masking(spark):
    docs = edge_docs(spark)
    found = pii.detected(docs)
    assert found.count() == docs.count() and found.select("row.*").columns == docs.columns
    masked = pii.masked(docs)
    assert masked.columns == docs.columns
    assert masked.where("doc_id = 13").first()["text"] == "mail [EMAIL] or [CARD]"
    assert masked.where("text is null").count() == docs.where("text is null").count()
    assert pii.detected(empty_docs(spark)).count() == 0 and pii.masked(empty_docs(spark)).count() == 0


def test_spelled_out_addresses_cost_time_in_proportion_to_the_text():
    beta = np.zeros(len(pii.KINDS) + 2 * len(pii.LABELERS))
    text = "john (at) b.co a@ b@c.de "
    found = pii.spans_of(text * 40_000, beta, -1)           # a million characters
    once = pii.spans_of(text, beta, -1)
    assert len(found) == 40_000 * len(once)
    assert [(k, a - 25 * 39_999, b - 25 * 39_999, base) for k, a, b, base in found if a >= 25 * 39_999] == once
