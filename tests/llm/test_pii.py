import hashlib
import random
import re

from tarnwork.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """The base spans, straight from the four patterns."""
    out = []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            double = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in double) % 10 == 0,
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{list(PATTERNS)[k]}:{s}:{e}" for s, k, e in spans)


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(4)
    for alphabet in ("a@.-_1 ", "12.3 -+", "+1()- .9", "4 -0+.@a", "é٣1.@ü+2-"):
        for _ in range(6000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert [(s, k, e) for s, k, e, _ in pii.scan(text)[0]] == plain(text), text


def test_candidates_touch_nothing():
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice(["a", "@", ".", " at ", " dot ", "1", "555 ", "token=", "abcdef", "+", "4111111111111111", "-"]) for _ in range(30))
        base, more = pii.scan(text)
        spans = sorted((s, e) for s, _, e, _ in more)
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
        assert not any(s < e2 and s2 < e for s, e in spans for s2, _, e2, _ in base)


def test_long_digit_runs_between_dots_are_voted_on():
    rng = random.Random(7)
    texts = ["0" * k + ".1.2.3" for k in range(55, 75)] + ["1" * 61 + "." + "2" * 70 + ".3.4"]
    texts += ["".join(rng.choice(["1", "0", ".", "25", "0" * rng.randint(55, 70), " "]) for _ in range(rng.randint(4, 60))) for _ in range(2000)]
    for text in texts:
        base, more = pii.scan(text)
        assert [(s, k, e) for s, k, e, _ in base] == plain(text), text
        for start, kind, end, pattern in base + more:
            pii.votes(text, start, kind, end, pattern)


def test_spelled_out_address_is_found_whole():
    text = "mail " + "x" * 300 + " (at) example (dot) com"
    assert (5, 0, len(text)) in [m[:3] for m in pii.scan(text)[1]]


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a." * 100_000 + "@", "+1" + "(" * 200_000, "1.2.3." * 50_000, "a@" * 100_000, " at " * 50_000, "a" * 200_000 + " at b", "(at)a" * 40_000, "f" * 200_000, "token" + " " * 100_000):
        pii.scan(text)


def test_em_finds_the_reliable_labelers():
    rng = random.Random(6)
    counts, truth = {}, {}
    for _ in range(4000):
        real = rng.random() < 0.3
        sure = [0.99, 0.9, 0.8, 0.9, 0.55]
        voted = [(1 if real else -1) * (1 if rng.random() < p else -1) if rng.random() < 0.8 else 0 for p in sure]
        code = pii.coded(voted)
        counts[code] = counts.get(code, 0) + 1
        truth.setdefault(code, []).append(real)
    found = pii.em(counts)
    right = sum(sum(r == (found[c] >= 0.5) for r in rows) for c, rows in truth.items())
    majority = sum(sum(r == (sum((c // 3**i) % 3 - 1 for i in range(5)) > 0) for r in rows) for c, rows in truth.items())
    assert right > 0.95 * 4000 and right >= majority


ROWS = [
    (1, "mail joe@x.org or joe (at) example (dot) com now"), (2, None), (3, ""), (4, "call +1 (017) 555-7713, phone 017 555 7713."), (5, "card 4111 1111 1111 1111"), (9, "the order 4111111111111112 went"),
    (6, "host 10.0.0.1 and 300.1.1.1"), (6, "host 10.0.0.1 and 300.1.1.1"), (None, "ü" * 70_000 + " a@b.cd"), (7, 'token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" text'), (8, "the house is at home"),
]


def test_odd_rows(frame):
    df = frame([(*r, "z", 3) for r in ROWS], "doc_id long, text string, spans string, kind int")
    found = pii.personal_data(df).collect()
    assert len(found) == len(ROWS)
    texts = dict(ROWS)
    for r in found:
        text = texts[r.doc_id] or ""
        assert ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.base) == listed(plain(text))
        assert all(0 <= s.score <= 1 and s.end <= len(text) for s in r.spans)
    by_id = {r.doc_id: [(s.kind, texts[r.doc_id][s.start : s.end]) for s in r.spans] for r in found if texts[r.doc_id]}
    assert ("email", "joe (at) example (dot) com") in by_id[1] and ("secret", "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde") in by_id[7]
    assert by_id[5] == [("card", "4111 1111 1111 1111")] and by_id[6] == [("ip", "10.0.0.1")] and by_id[8] == [] == by_id[9]
    assert pii.redacted("a joe@x.org b", [{"start": 2, "end": 11, "kind": "email"}]) == "a [email] b"
    assert pii.personal_data(frame([], "doc_id long, text string")).collect() == []


def test_all_documents(spark, sf_dir):
    documents = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = pii.op2_pii(spark, sf_dir).collect()
    assert {r.doc_id for r in found} == set(documents) and len(found) == len(documents)
    seen = 0
    for r in found:
        spans = plain(documents[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for _, k, _ in spans) for i in range(4)]
        assert set(filter(None, listed(spans).split(","))) <= set(r.spans.split(","))
        seen += len(spans)
    assert seen > 0


def test_an_assigned_secret_is_taken_to_its_end():
    value = "aB3_" * 100
    assert pii.scan(f"token={value} and more") == ([], [(6, 4, 406, 1)])
    text = f"token={value}:4111111111111111:{value}."
    base, more = pii.scan(text)
    assert [text[s:e] for s, _, e, _ in base] == ["4111111111111111"]
    assert [(s, e) for s, _, e, _ in more] == [(6, base[0][0]), (base[0][2], len(text))]
    spans = [{"kind": "x", "start": s, "end": e} for s, _, e, _ in base + more]
    assert pii.redacted(text, spans) == "token=[x][x][x]"
