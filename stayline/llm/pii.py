"""Personal data by weak supervision.

Candidates are found per whole text: the base spans of the four kinds, and
looser ones (emails with spelled-out signs, numbers inside a longer match that
failed, national phone formats, IPv6).  Regex, checksum, gazetteer and context
labelers vote yes, no or nothing on each.  The votes of the whole corpus are
counted by pattern (one grouped count, at most ``MAX_PATTERNS`` rows whatever
the corpus); expectation-maximisation on these counts estimates each labeler's
reliability per kind, and a logistic span classifier is trained on the
posteriors.  Base spans always stay; the classifier adds other candidates that
pass their kind's validity check.

Defined cases: a null text has no spans; texts of any length are scanned
whole, in time linear in their length; repeated rows give the same spans; with
an empty table or no candidates nothing is added; other columns pass through,
and rows are packed in a struct, so no column name clashes.  Offsets are code
points, end exclusive.
"""

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .batches import text_slices

KINDS = ("email", "ip", "card", "phone")
#: Character classes and forms of the base spans.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Looser forms, tried where the base finds nothing.
SPELLED_AT = re.compile(r"\s?[(\[{]\s?at\s?[)\]}]\s?", re.I)
SPELLED_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\s?(?:\.|[(\[{]\s?dot\s?[)\]}])\s?[A-Za-z0-9-]+)+", re.I)
ANY_DOMAIN = re.compile(r"[^\s@<>()\[\]{}\"',;:!?]+")
IP6 = re.compile(r"(?<![\w:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![\w:])")
#: From every group of digits, so that a wrong start hides no right one.
CARD_FORM = re.compile(r"(?<![0-9])(?=([0-9]{13,19}(?![0-9])|[0-9]{4}([\x20-])[0-9]{4}\2[0-9]{4}\2[0-9]{4}(?![0-9])|3[47][0-9]{2}([\x20-])[0-9]{6}\3[0-9]{5}(?![0-9])))")
PHONE_FORM = re.compile(r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])")
DIGITS = re.compile(r"[0-9]+")
NOT_LOCAL = re.compile(r"[\s@<>()\[\]{}\"',;:!?]")
NATIONAL = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\)[\x20-]?|[0-9]{3}-)[0-9]{3}-[0-9]{4}(?![0-9.-])")

STRICT = {
    "email": re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,24}"),
    "ip": re.compile(r"(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}|(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"),
    "card": re.compile(r"[0-9]{13,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}([\x20-])[0-9]{6}\2[0-9]{5}"),
    "phone": re.compile(r"\+[0-9]{1,3}[\x20.-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[\x20.-]?[0-9]{2,4}){2,3}|\([0-9]{3}\)[\x20-]?[0-9]{3}-[0-9]{4}"),
}
#: Gazetteers.
SUFFIXES = frozenset("com org net edu gov mil int info biz io co me dev app ai uk de fr es it nl eu us ca au at ch be pt pl se no dk fi example".split())
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 212 213 216 234 254 351 352 353 354 358 359 370 371 372 380 420 421 852 886 971 972".split())
NEAR = {
    "email": re.compile(r"(?i)\b(?:e-?mail|mail|contact|write|reply|correo|courriel|kontakt|schreib\w*)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|address|host|server|login|logged|client|adresse|direcci[oó]n)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|mastercard|amex|credit|debit|payment|karte|carte|tarjeta)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax|whatsapp|telefon|t[eé]l[eé]phone|tel[eé]fono)\b"),
}
AGAINST = re.compile(r"(?i)(?:\b(?:version|release|build|isbn|issn|doi|order|invoice|ref|serial|token|key|hash|sha|md5|secret|build)\b|[=#$/\\_])[\s:\"']*$")
CONTEXT = 48            # code points looked at before a candidate

LABELERS = ("strict form", "validity", "gazetteer", "context", "counter-context", "boundary", "base pattern")
ABSTAIN, YES, NO = 0, 1, 2
MAX_PATTERNS = len(KINDS) * 3 ** len(LABELERS)
THRESHOLD = 0.5


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def digits_of(text):
    return "".join(c for c in text if "0" <= c <= "9")


def valid(kind, found):
    """Whether a span may be added: the kind's hard check."""
    if kind == "email":
        tail = re.split(r"[.\]\)}\s]+", found)[-1]
        return tail.isalpha() and 2 <= len(tail) <= 24
    if kind == "ip":
        return ":" in found or all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in found.split("."))
    digits = digits_of(found)
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def base_spans(text):
    """Base spans (kind, start, end) in order, and the matches that failed."""
    spans, failed = [], []
    end, at = 0, text.find("@")
    while at >= 0:
        if at >= end:
            tail = DOMAIN.match(text, at + 1)
            start = at
            while tail and start > end and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                spans.append(("email", start, tail.end()))
                end = tail.end()
            else:
                failed.append(("email", at, at + 1))
        at = text.find("@", at + 1)
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        for m in pattern.finditer(text):
            (spans if valid(kind, m.group()) else failed).append((kind, m.start(), m.end()))
    return spans, failed


def phone_prefixes(text, start, end):
    """Ends of the numbers of 9 to 15 digits that a longer match begins with, likely ones first."""
    digits, ends = 0, []
    for m in DIGITS.finditer(text, start, end):
        digits += len(m.group())
        if digits > 15:
            break
        found = text[start:m.end()]
        if digits >= 9 and found.count("(") == found.count(")"):
            ends.append(m.end())
    form = PHONE_FORM.match(text, start, end)
    return sorted(ends, key=lambda e: (not (form and e == form.end()), not text[e:e + 1].isspace(), -e))


def looser_spans(text, failed):
    """Candidates beside the base spans."""
    for kind, start, end in failed:
        if kind == "email":
            left = text[text.rfind("@", 0, start) + 1:start][::-1]
            stop, tail = NOT_LOCAL.search(left), ANY_DOMAIN.match(text, end)
            own = stop.start() if stop else len(left)
            if own and tail and "." in tail.group().strip("."):
                yield "email", start - own, end + len(tail.group().rstrip(".*#$%&"))
        elif kind == "card" and end - start > 13:
            for m in CARD_FORM.finditer(text, start, end):
                yield "card", m.start(1), m.end(1)
        elif kind == "phone":
            for stop in phone_prefixes(text, start, end):
                yield "phone", start, stop
    if "at" in text or "AT" in text:
        before = 0
        for m in SPELLED_AT.finditer(text):
            left = text[before:m.start()]
            before = m.end()
            own, tail = len(left) - len(left.rstrip(LOCAL)), SPELLED_DOMAIN.match(text, m.end())
            if own and tail:
                yield "email", m.start() - own, tail.end()
    if text.count(":") >= 7:
        for m in IP6.finditer(text):
            yield "ip", m.start(), m.end()
    for m in NATIONAL.finditer(text):
        yield "phone", m.start(), m.end()


def votes(text, kind, start, end, base):
    """One vote per labeler."""
    found, before = text[start:end], text[max(0, start - CONTEXT):start]
    if kind == "email":
        known = found.rpartition(".")[2].lower() in SUFFIXES
    elif kind == "ip":
        known = ":" in found or found.split(".")[0].lstrip("0") not in ("", "255") and int(found.split(".")[0][-3:]) < 224
    elif kind == "card":
        known = found[0] in "3456"
    else:
        code = digits_of(found[:6]) if found[0] == "+" else "1"
        known = any(code[:n] in CALLING_CODES for n in (1, 2, 3))
    left, right = text[start - 1:start] if start else " ", text[end:end + 1] or " "
    open_ = not (left.isalnum() or left in "_\"'") and not (right.isalnum() or right in "_\"'")
    return (YES if STRICT[kind].fullmatch(found) else NO, YES if valid(kind, found) else NO, YES if known else NO,
            YES if NEAR[kind].search(before) else ABSTAIN, NO if AGAINST.search(before) else ABSTAIN,
            YES if open_ else NO, YES if base else ABSTAIN)


def candidates(text):
    """(kind number, start, end, base, votes) of every candidate of a text."""
    spans, failed = base_spans(text)
    rows = [(KINDS.index(k), a, b, True, votes(text, k, a, b, True)) for k, a, b in spans]
    more = dict.fromkeys((k, a, b) for k, a, b in looser_spans(text, failed))
    known = set(spans)
    return rows + [(KINDS.index(k), a, b, False, votes(text, k, a, b, False)) for k, a, b in more if (k, a, b) not in known]


def pattern_code(kind, given):
    code = kind
    for v in given:
        code = 3 * code + v
    return code


def pattern_votes(codes):
    """(kinds, votes) of pattern codes."""
    codes, given = np.asarray(codes, np.int64), []
    for _ in LABELERS:
        given.append(codes % 3)
        codes = codes // 3
    return codes, np.stack(given[::-1], axis=1)


def estimate(kinds, given, weight, rounds=100):
    """Posterior that a pattern is personal data, by expectation-maximisation
    over two classes with independent labelers, for each kind on its own."""
    yes, no = (given == YES).sum(axis=1), (given == NO).sum(axis=1)
    posterior = (yes + 0.5) / (yes + no + 1.0)
    for k in np.unique(kinds):
        own = kinds == k
        w, seen, p = weight[own], given[own], posterior[own]
        for _ in range(rounds):
            logit = np.log((w @ p + 1) / (w @ (1 - p) + 1))
            for j in range(seen.shape[1]):
                rate = [[(w * q) @ (seen[:, j] == v) + (10.0 if v == lean else 1.0) for v in (ABSTAIN, YES, NO)]
                        for q, lean in ((p, YES), (1 - p, NO))]
                rate = np.array(rate) / np.sum(rate, axis=1, keepdims=True)
                logit = logit + np.log(rate[0] / rate[1])[seen[:, j]]
            new = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
            done = np.abs(new - p).max() < 1e-9
            p = new
            if done:
                break
        posterior[own] = p
    return posterior


def features(kinds, given):
    columns = [kinds == k for k in range(len(KINDS))]
    columns += [given[:, j] == v for j in range(given.shape[1]) for v in (YES, NO)]
    return np.stack(columns, axis=1).astype(float)


def train(kinds, given, weight, target, ridge=1.0, rounds=50):
    """Logistic span classifier on soft targets, by Newton steps."""
    x = features(kinds, given)
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (target - p)) - ridge * beta
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta)), slope)
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def pattern_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """How often each vote pattern occurs in all texts: (code, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()
        for batch in batches:
            for part in text_slices(batch.column(0)):
                for t in part.to_pylist():
                    seen.update(pattern_code(k, v) for k, _, _, _, v in candidates(t or ""))
        yield pa.RecordBatch.from_arrays([pa.array(list(seen.keys()), pa.int64()), pa.array(list(seen.values()), pa.int64())], ["code", "n"])

    found = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(run, "code long, n long")
    return found.groupBy("code").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text"):
    """Weights of the span classifier, from all rows of ``docs``."""
    rows = sorted((r["code"], r["n"]) for r in pattern_counts(docs, text).collect())     # at most MAX_PATTERNS rows
    if not rows:
        return np.zeros(len(KINDS) + 2 * len(LABELERS))
    kinds, given = pattern_votes([c for c, _ in rows])
    weight = np.array([n for _, n in rows], float)
    return train(kinds, given, weight, estimate(kinds, given, weight))


def spans_of(text, beta, threshold=THRESHOLD):
    """All spans (kind number, start, end, base) by kind, then start."""
    found = candidates(text)
    spans = [(k, a, b, True) for k, a, b, base, _ in found if base]
    rest = [c for c in found if not c[3]]
    if rest:
        logit = features(np.array([c[0] for c in rest]), np.array([c[4] for c in rest])) @ beta
        score = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
        taken = bytearray(len(text))        # code points inside a span
        for _, a, b, _ in spans:
            taken[a:b] = b"\1" * (b - a)
        for (k, a, b, _, _), p in sorted(zip(rest, score.tolist()), key=lambda x: (-x[1], x[0][1])):
            if p > threshold and valid(KINDS[k], text[a:b]) and taken.find(1, a, b) < 0:
                spans.append((k, a, b, False))
                taken[a:b] = b"\1" * (b - a)
    return sorted(spans)


def find_spans(beta) -> Column:
    """Column function text -> array of (kind, start, end, base)."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [[{"kind": KINDS[k], "start": a, "end": b, "base": base} for k, a, b, base in spans_of(t or "", beta)]
                    for part in text_slices(batch) for t in part.to_pylist()]
            yield pa.array(rows, kind)

    return F.arrow_udf(run, "array<struct<kind: string, start: int, end: int, base: boolean>>")


def mask_spans(beta) -> Column:
    """Column function text -> text with each span replaced by its kind; null stays null."""

    def masked(text):
        out, end = [], 0
        for k, a, b, _ in sorted(spans_of(text, beta), key=lambda s: s[1]):
            if a >= end:
                out += [text[end:a], f"[{KINDS[k].upper()}]"]
            end = max(end, b)
        return "".join(out) + text[end:]

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([t if t is None else masked(t) for part in text_slices(batch) for t in part.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")


def detected(docs: DataFrame, text: str = "text") -> DataFrame:
    """``row`` (the input row) and ``spans``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    return docs.select(row, find_spans(fit(docs, text))(F.col(f"`{text}`")).alias("spans"))


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of its texts replaced."""
    return docs.withColumn(text, mask_spans(fit(docs, text))(F.col(f"`{text}`")))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
