"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs the labelers, a classifier decides.

Pass 1 finds the base spans of a text and looser candidates, and lets the
labelers (pattern, shape, gazetteer, context, surroundings) vote yes, no or
nothing on each. The votes' patterns are counted over all data; expectation
maximisation over these few counts estimates how reliable each labeler is per
kind. Its posteriors are the labels of a logistic regression over sparse span
features, which then decides on every candidate.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnwork.llm.common import col, table
from tarnwork.llm.registry import query
from tarnwork.session import settle

KINDS = ("email", "ip", "card", "phone", "secret")
LABELERS = ("pattern", "shape", "gazetteer", "context", "surroundings")
FEATURES = 4096

# The base patterns. Runs are taken whole (possessive), so no text makes them slow;
# where a run cannot start a match, no later start within it can.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
QUAD = re.compile(r"[0-9]++(?:(?:\.[0-9]++){3})?+")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

# Looser candidates.
AT_WORD = re.compile(r"\s?[(\[{]\s?at\s?[)\]}]\s?|\sat\s", re.I)
DOTTED = re.compile(r"[A-Za-z0-9-]++(?:(?:\s?[(\[{]\s?dot\s?[)\]}]\s?|\sdot\s|\.)[A-Za-z0-9-]++)++", re.I)
BARE_HOST = re.compile(r"[A-Za-z0-9-]++")
LOCAL_PHONE = re.compile(r"(?<![0-9.+-])\(?[0-9]{2,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9.-])")
ASSIGNED = re.compile(r"(?:token|secret|api[_-]?key|access[_-]?key|passw(?:or)?d|pwd)\s{0,3}[=:]\s{0,3}[\"']?([^\s\"']{6,}+)", re.I)
LONG_HEX = re.compile(r"[0-9A-Fa-f]{32,}+")

# Gazetteers and cue words of the labelers.
ENDINGS = frozenset("com org net edu gov int info biz io de fr es it nl uk us eu ch at pl jp cn br in ru".split())
CUES = {
    "email": frozenset("mail email e-mail contact write correo courriel kontakt".split()),
    "ip": frozenset("ip host server address from login client gateway".split()),
    "card": frozenset("card visa mastercard amex credit debit payment karte carte tarjeta".split()),
    "phone": frozenset("phone tel telephone call mobile cell fax contact telefon téléphone teléfono".split()),
    "secret": frozenset("token secret key password passwd pwd apikey api_key credentials".split()),
}
COUNTER_CUES = frozenset("order invoice isbn issn version serial doi section chapter release page figure sku part number id".split())
WORDS = re.compile(r"[\w-]+")


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (found := DOMAIN.match(text, at + 1)):
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(done, at + 1))


def small(part: str) -> bool:
    return len(part := part.lstrip("0")) <= 3 and int(part or 0) <= 255


def scan(text: str) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int, int, int]]]:
    """Base spans and further candidates, each ``(start, kind, end, vote of the pattern)``."""
    return scan_values(text)[:2]


def scan_values(text: str) -> tuple[list, list, dict[tuple[int, int], tuple[int, int]]]:
    """The spans of ``scan``, and the whole value by each piece of an assigned one that base spans cut."""
    base, more = [], []
    if "@" in text:
        base += [(s, 0, e, 1) for s, e in emails(text)]
    for m in QUAD.finditer(text):
        if "." in m.group():
            good = all(map(small, m.group().split(".")))
            (base if good else more).append((m.start(), 1, m.end(), 1 if good else -1))
    for m in DIGITS.finditer(text):
        digits = NOT_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19:
            good = luhn(digits)
            (base if good else more).append((m.start(), 2, m.end(), 1 if good else -1))
    if "+" in text:
        for m in PHONE.finditer(text):
            good = 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15
            (base if good else more).append((m.start(), 3, m.end(), 1 if good else -1))
    done = 0
    for m in AT_WORD.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        done = m.end()
        if start < m.start() and (found := DOTTED.match(text, m.end())):
            more.append((start, 0, found.end(), 0))
    for m in LOCAL_PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
            more.append((m.start(), 3, m.end(), 0))
    base.sort()
    values, at = {}, 0
    for m in ASSIGNED.finditer(text):
        start, end = m.span(1)
        while at < len(base) and base[at][2] <= start:
            at += 1
        k = at
        while k < len(base) and base[k][0] < end:
            if base[k][0] > start:
                values[start, base[k][0]] = m.span(1)
            start = max(start, base[k][2])
            k += 1
        if start < end:
            values[start, end] = m.span(1)
    more += [(start, 4, end, 1) for start, end in values]
    more += [(m.start(), 4, m.end(), 0) for m in LONG_HEX.finditer(text)]
    return base, apart(base, more), values


def apart(base: list, more: list) -> list:
    """Those of ``more`` that touch neither a base span nor an earlier one of ``more``."""
    taken, out, at = [(s, e) for s, _, e, _ in base], [], 0
    taken = sorted(taken)
    longest = 0  # how far the base spans before ``at`` reach
    free = 0
    for span in sorted(more, key=lambda x: (x[0], -abs(x[3]), x[1])):
        start, _, end, _ = span
        while at < len(taken) and taken[at][0] < end:
            longest = max(longest, taken[at][1])
            at += 1
        if start >= longest and start >= free:
            out.append(span)
            free = end
    return out


def votes(text: str, start: int, kind: int, end: int, pattern: int) -> tuple[list[int], list[int]]:
    """Votes of all labelers (1 yes, 0 nothing, -1 no) and the sparse features of the span."""
    span, name = text[start:end], KINDS[kind]
    before = [w.lower() for w in WORDS.findall(text[max(0, start - 48) : start])][-5:]
    after = [w.lower() for w in WORDS.findall(text[end : end + 24])][:1]
    digits = NOT_DIGIT.sub("", span[:512])
    shape = gazetteer = 0
    if name == "email":
        host = re.split(r"[.\s]", span[:512])
        shape = 1 if len(host) > 1 and host[-1].isalpha() and len(host[-1]) >= 2 else -1
        gazetteer = 1 if host[-1].lower() in ENDINGS else 0
    elif name == "ip":
        parts = span.split(".")
        shape = 1 if all(p == str(int(p)) for p in parts if len(p) < 9) and max(map(len, parts)) <= 3 else -1
        gazetteer = -1 if parts[0] in ("0", "00", "255") else 0
    elif name == "card":
        shape = 1 if len(digits) in (15, 16) else -1
        gazetteer = 1 if digits[0] == "4" or digits[:2] in ("34", "37", "51", "52", "53", "54", "55", "60", "65") else -1
    elif name == "phone":
        shape = 1 if 10 <= len(digits) <= 13 else -1
        gazetteer = 1 if span[0] == "+" and digits[0] != "0" else 0
    else:
        shape = 1 if len(span) >= 16 and any(c.isdigit() for c in span) else -1
        gazetteer = 1 if LONG_HEX.fullmatch(span) else 0
    context = 1 if not CUES[name].isdisjoint(before) else -1 if not COUNTER_CUES.isdisjoint(before) else 0
    outer = text[start - 1 : start] + text[end : end + 1]
    surroundings = -1 if any(c.isalnum() or c in "_@" for c in outer) else 1
    voted = [pattern, shape, gazetteer, context, surroundings]
    form = re.sub(r"[A-Za-z]+", "a", re.sub(r"[0-9]+", "9", span[:256]))[:24]
    named = [f"{name}|{k}|{v}" for k, v in zip(LABELERS, voted, strict=True)]
    named += [f"{name}|form|{form}", f"{name}|size|{len(digits)}", f"{name}|before|{before[-1:]}", f"{name}|after|{after}", name]
    return voted, [zlib.crc32(f.encode()) % FEATURES for f in named]


def coded(voted: list[int]) -> int:
    return sum((v + 1) * 3**i for i, v in enumerate(voted))


def em(counts: dict[int, float], rounds: int = 200, prior: float = 0.5) -> dict[int, float]:
    """Probability that a candidate is real, by vote pattern, from the patterns' counts.

    Votes are independent given the truth. Before any data a labeler is taken to be right in
    eight of ten votes (the pattern, which knows checksums and ranges, in 97 of 100), with ``prior``
    times the weight of the data; without that, two classes that no vote ties to a meaning could change places.
    """
    patterns = np.array([[(code // 3**i) % 3 for i in range(len(LABELERS))] for code in counts])
    weight = np.array(list(counts.values()), float)
    one_hot = patterns[:, :, None] == np.arange(3)
    right = np.array([0.97] + [0.8] * (len(LABELERS) - 1))
    silent = np.clip((weight[:, None] * (patterns == 1)).sum(0) / weight.sum(), 0.01, 0.98)
    start = np.stack([np.stack([(1 - silent) * (1 - p), silent, (1 - silent) * p], 1) for p in (1 - right, right)])  # class, labeler, vote
    rates, share = start.copy(), 0.5
    for _ in range(rounds):
        log = np.stack([np.log(rates[c])[np.arange(len(LABELERS)), patterns].sum(1) for c in (0, 1)])
        log += np.log([[1 - share], [share]])
        real = 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))
        share = float(np.clip((real @ weight + 1) / (weight.sum() + 2), 0.01, 0.99))
        for c, part in ((0, 1 - real), (1, real)):
            seen = np.einsum("p,plv->lv", part * weight, one_hot) + start[c] * prior * weight.sum()
            rates[c] = seen / seen.sum(1, keepdims=True)
    return dict(zip(counts, real.tolist(), strict=True))


def fit(features: list[list[int]], real: list[float], steps: int = 300, rate: float = 0.2, penalty: float = 1e-4) -> np.ndarray:
    """Logistic regression on sparse 0/1 features and soft labels (Adam); the last weight is the bias."""
    w, m, v = np.zeros(FEATURES + 1), np.zeros(FEATURES + 1), np.zeros(FEATURES + 1)
    if not features:
        return w
    index, label = np.array([[*f, FEATURES] for f in features]), np.array(real)
    for step in range(1, steps + 1):
        off = 1 / (1 + np.exp(-w[index].sum(1))) - label
        slope = np.bincount(index.ravel(), np.repeat(off, index.shape[1]), FEATURES + 1) / len(label) + penalty * w
        m += 0.1 * (slope - m)
        v += 0.01 * (slope**2 - v)
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return w


CANDIDATE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("base", pa.bool_()), ("code", pa.int32()), ("features", pa.list_(pa.int32()))])
SPANS = "array<struct<start:bigint,end:bigint,kind:int,base:boolean,code:int,features:array<int>>>"


def candidates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, spans``: base spans and candidates of each row, with votes and features; offsets are code points of the whole text."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in batch.column("text"):
                text = text.as_py() or ""
                base, more, values = scan_values(text)
                row = []
                for is_base, spans in ((True, base), (False, more)):
                    for start, kind, end, pattern in spans:
                        whole = values.get((start, end), (start, end)) if kind == 4 else (start, end)
                        voted, features = votes(text, whole[0], kind, whole[1], pattern)
                        row.append({"start": start, "end": end, "kind": kind, "base": is_base, "code": coded(voted), "features": features})
                row.sort(key=lambda x: (x["start"], x["kind"]))
                found.append(row)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.list_(CANDIDATE))], ["doc_id", "spans"])

    rows = df.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    return rows.mapInArrow(find, f"doc_id long, spans {SPANS}")


def reliabilities(found: DataFrame) -> dict[tuple[int, int], float]:
    """EM per kind over the counts of all vote patterns: at most 3 to the number of labelers per kind."""
    counts: dict[int, dict[int, float]] = {}
    for r in found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.code").count().orderBy("kind", "code").collect():
        counts.setdefault(r.kind, {})[r.code] = float(r["count"])
    return {(kind, code): p for kind, patterns in counts.items() for code, p in em(patterns).items()}


def classifier(found: DataFrame, real: dict[tuple[int, int], float], rows_per_kind: int = 4_000) -> np.ndarray:
    """The span classifier, fitted on about ``rows_per_kind`` candidates of each kind chosen by a hash, with EM's posteriors as labels."""
    spans = found.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.start", "s.kind", "s.code", "s.features")
    sizes = {r.kind: r["count"] for r in spans.groupBy("kind").count().collect()}
    if not sizes:
        return fit([], [])
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, rows_per_kind / n))]), F.col("kind"))
    chance = F.pmod(F.xxhash64("doc_id", "start", "kind", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    most = 2 * rows_per_kind * len(KINDS)
    sample = spans.where(chance < share).orderBy(chance, "doc_id", "start", "kind", "code").limit(most).collect()
    return fit([r.features for r in sample], [real[r.kind, r.code] for r in sample])


def personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8) -> DataFrame:
    """Per row ``doc_id, spans``: structs ``kind, start, end, base, score`` by start, then kind.

    Base spans are always there; a candidate is added where the classifier gives it at least ``threshold`` and
    it overlaps no base span. A NULL text is empty and an empty text has no spans; repeated rows
    give repeated results, an empty table none; other columns are ignored.
    """
    found = settle(candidates(df, id_col, text_col), "spans")
    weights = df.sparkSession.sparkContext.broadcast(classifier(found, reliabilities(found)))
    out = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches:
            kept = []
            for spans in batch.column("spans").to_pylist():
                row = []
                for s in spans:
                    score = float(1 / (1 + np.exp(-(w[s["features"]].sum() + w[-1]))))
                    if s["base"] or score >= threshold:
                        row.append({"kind": KINDS[s["kind"]], "start": s["start"], "end": s["end"], "base": s["base"], "score": score})
                kept.append(row)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(kept, pa.list_(out))], ["doc_id", "spans"])

    schema = "doc_id long, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean,score:double>>"
    return found.mapInArrow(decide, schema)


def redacted(text: str, spans: list) -> str:
    """``text`` with each span, overlapping ones as one, replaced by its kind in brackets."""
    pieces, done = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= done:
            pieces += [text[done : s["start"]], f"[{s['kind']}]"]
        done = max(done, s["end"])
    return "".join(pieces) + text[done:]


@query("op2_pii")
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    found = personal_data(table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    def listed(only_base: bool):
        spans = F.filter("spans", lambda s: s["base"]) if only_base else F.col("spans")
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    secrets = F.size(F.filter("spans", lambda s: s["kind"] == "secret")).cast("long").alias("n_secret")
    return found.select(
        "doc_id", *[count(k) for k in KINDS[:4]], F.sha2(listed(True), 256).alias("base_sha256"), listed(False).alias("spans"), secrets, F.size("spans").cast("long").alias("n_found")
    )
