"""Base spans against Python's patterns; labellers, EM and the classifier on planted cases."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sparkwarden.llm import personal_data as pd

from .helpers import docs_of

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def card(r):
    body = "4" + "".join(r.choice("0123456789") for _ in range(14))
    return next(body + c for c in "0123456789" if luhn(body + c))


def base_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "card" and 16 <= len(digits) <= 19 and luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15:
                out.append((kind, m.start(), m.end()))
    return out


def listed(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


ODD = [
    None, "", " ", "a@b.c%x@y.z", "a@b.c@d.e.f", "x..y@-.-.-", "1.2.3.4.5.6.7.8", "0255.01.2.3 256.1.1.1 1.1.1.00", "1..2.3.4", "+1", "+1 +22 333 4444 5", "++49 (0) 30 1234567 ",
    "+1 (826) 555-4081 190.137.223.204", "4111 1111 1111 1111-", "4111-1111-1111-1111 4111 1111 1111 1111", "é😀 a.b@c.de 😀 +49 30 1234567", "tel\x00+49-30-123 4567\x01 ", "١٢٣٤ ۱۲۳۴",
    "+1 " + " " * 5000 + "2345678", "a" * 30_000, "1" * 30_000, "1 " * 15_000, "a@" * 15_000, "a." * 15_000 + "@" + "b." * 15_000, "1." * 15_000, "+1" * 9_000, "(" * 20_000,
]


def mixed(r):
    parts = ["4111111111111111", "4111 1111 1111 1111", "12", "1.2.3.4", "300.1.1.1", "+1 (017) 555-7713", "me.x@mail.com", "@", ".", " ", "é", "😀", "\n", "+", "-", "a", "(", "00", card(r)]
    return "".join(r.choice(parts) for _ in range(r.randrange(1, 40)))


def test_base_spans_equal_brute_force(spark):
    r = random.Random(5)
    texts = ODD + [mixed(r) for _ in range(400)] + ["x " + " ".join(f"1.2.3.{k % 300} a{k}@b.com" for k in range(2_000))]
    got = {row.doc_id: row for row in pd.find_personal_data(docs_of(spark, texts, extra=True)).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        base = base_spans(text or "")
        kinds = [s[0] for s in base]
        row = got[k]
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(kinds.count(x) for x in PATTERNS), text
        assert row.base_sha256 == hashlib.sha256(listed(base).encode()).hexdigest(), text
        spans = [(s.split(":")[0], *map(int, s.split(":")[1:])) for s in row.spans.split(",") if s]
        assert set(base) <= set(spans) and len(spans) == len(base) + row.n_added and spans == sorted(spans, key=lambda s: ([*PATTERNS].index(s[0]), s[1]))
        for kind in PATTERNS:
            own = [s for s in spans if s[0] == kind]
            assert all(a[2] <= b[1] for a, b in zip(own, own[1:]))  # noqa: RUF007


def test_classifier_adds_what_base_patterns_miss(spark):
    r = random.Random(6)
    texts = []
    for k in range(300):
        ip = ".".join(str(r.randrange(11, 120)) for _ in range(4))
        texts.append(f"words here {card(r)} and {ip} then u{k}.x@mail{k % 9}.example.com, more +1 ({r.randrange(200, 900)}) 555-{r.randrange(1000, 9999)} end")
        texts.append(f'plain words and token = "{r.randrange(16**20):020x}4{r.randrange(10**15):015d}ab" order {r.randrange(10**15):016d} closing')
    planted = [f"words 12345 {card(r)} {card(r)} words", "call +1 (826) 555-4081 190.137.223.204 words", "mail jane.roe [at] example [dot] com please", "nothing at all 12 times"]
    got = pd.find_personal_data(docs_of(spark, texts + planted)).orderBy("doc_id").collect()
    assert all(row.n_added == 0 for row in got[: len(texts)])
    cards, phone, mail, none = got[len(texts) :]
    assert cards.n_added == 2 and [s.split(":")[0] for s in cards.spans.split(",")] == ["card", "card"]
    a, b = map(int, phone.spans.split("phone:")[1].split(":"))
    assert planted[1][a:b] == "+1 (826) 555-4081" and phone.n_ip == 1
    assert mail.n_added == 1 and mail.spans == f"email:5:{5 + len('jane.roe [at] example [dot] com')}"
    assert none.spans == "" and none.n_added == 0


def test_em_finds_reliabilities():
    """Votes drawn from known labellers: the good ones are believed, the coin is not."""
    r = random.Random(7)
    right, counts, truth = [0.95, 0.9, 0.5, 0.85, 0.9], {}, {}
    for _ in range(4000):
        y = r.random() < 0.3
        votes = "".join("." if r.random() < 0.2 else "+" if (r.random() < p) == y else "-" for p in right)
        counts[2, votes] = counts.get((2, votes), 0) + 1
        truth.setdefault(votes, []).append(y)
    belief = pd.reliabilities(counts)
    wrong = sum(sum(ys) if belief[2, v] < 0.5 else len(ys) - sum(ys) for v, ys in truth.items())
    assert wrong < 0.05 * 4000 and 0.25 < sum(n * belief[key] for key, n in counts.items()) / 4000 < 0.35
    assert pd.reliabilities({}) == {}


def test_no_candidates_and_no_rows(spark):
    none = pd.find_personal_data(docs_of(spark, ["plain", None])).collect()
    assert [(row.spans, row.n_added, row.n_email) for row in none] == [("", 0, 0)] * 2
    assert pd.find_personal_data(docs_of(spark, [])).collect() == []


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
def test_starts_are_prefix_sums(spark, n):
    got = spark.range(1).select(pd.starts(F.slice(F.sequence(F.lit(1), F.lit(5000)), 1, n)).alias("x") if n else pd.starts(F.array(F.lit(7))).alias("x")).first().x
    assert got == ([sum(range(1, k + 1)) for k in range(n)] if n else [0])


def test_no_python_workers(spark):
    plan = pd.candidates(docs_of(spark, ["a"]).where("doc_id >= 0"), "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
