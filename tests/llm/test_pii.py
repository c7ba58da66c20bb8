"""Personal data against Python's patterns and a plain bootstrap."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from panelwright.llm import contextual_pii as cp
from tests.llm import fixtures

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SOLID = r"[^\x20\x09-\x0D]"


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(reversed(digits))) % 10 == 0


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return {"email": True, "ip": all(int(p) <= 255 for p in text.split(".")) if kind == "ip" else True, "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]


def searched(text, matches):
    """(start, end, text, left, right) with what lies between a match and its neighbours."""
    out = []
    for i, (a, b) in enumerate(matches):
        begin = matches[i - 1][1] if i else 0
        end = matches[i + 1][0] if i + 1 < len(matches) else len(text)
        out.append((a, b, text[a:b], text[max(begin, a - cp.CONTEXT) : a], text[b : min(end, b + cp.CONTEXT)]))
    return out


def found(text):
    base = []
    for k, kind in enumerate(cp.KINDS):
        spans = [m.span() for m in re.finditer(BASE[kind], text)]
        if kind == "card":  # only long enough ones are searched for
            spans = [s for s in spans if 16 <= len(re.sub("[^0-9]", "", text[slice(*s)])) <= 19]
        base += [(k, *x) for x in searched(text, spans) if valid(kind, x[2])]
    words = [m.span() for m in re.finditer(f"{SOLID}+", text) if "@" in m[0] or len(re.findall("[0-9]", m[0])) >= cp.DIGITS]
    other = []
    for a, b, word, left, right in searched(text, words):
        lead = len(re.match(r"[^A-Za-z0-9+]*", word)[0])
        core = re.sub(r"(?<=[A-Za-z0-9])[^A-Za-z0-9]+\Z", "", word[lead:])
        a, b = a + lead, a + lead + len(core)
        if core and not any(x[1] < b and x[2] > a for x in base):
            other.append((cp.OTHER, a, b, core, left, right))
    return base + other


def patterns(left, right):
    words = lambda s: re.findall(f"{SOLID}+", re.sub("[0-9]", "9", s.lower()))
    l, r = ["^", "^", *words(left)], [*words(right), "^", "^"]
    return {f"{l[-2]} {l[-1]} _", f"{l[-1]} _ {r[0]}", f"_ {r[0]} {r[1]}"}


def brute(data):
    by_text = {t: found(t) for t in {r[1] or "" for r in data}}
    edges = defaultdict(lambda: cp.OTHER)
    for spans in by_text.values():
        for k, _, _, text, left, right in spans:
            for p in patterns(left, right):
                edges[p, text.lower()] = min(edges[p, text.lower()], k)
    size, known = Counter(p for p, _ in edges), {}
    for _ in range(cp.ROUNDS):
        sums, support = Counter(), Counter()
        for (p, i), k in edges.items():
            k, score = (k, 1000) if k != cp.OTHER else known.get(i, (None, 0))
            if k is not None:
                sums[p, k] += score
                support[p, k] += 1
        votes = Counter()
        for (p, i), k in edges.items():
            for kind in range(4) if k == cp.OTHER else ():
                confidence = sums[p, kind] // (size[p] + 1)
                if support[p, kind] >= cp.SUPPORT and confidence >= cp.CONFIDENT:
                    votes[i, kind] += round(-math.log(1 - confidence / 1000) * 1e6)
        best = {}
        for (i, kind), w in votes.items():
            best[i] = max(best.get(i, (0, 0)), (w, -kind))
        known = {i: (-k, math.floor(1000 * (1 - math.exp(-w / 1e6)))) for i, (w, k) in best.items() if w >= round(-math.log(1 - cp.ACCEPTED / 1000) * 1e6)}
    out = []
    for doc_id, text, *_ in data:
        own = by_text[text or ""]
        base = sorted((k, a, b) for k, a, b, *_ in own if k != cp.OTHER)
        more = [(known[t.lower()][0], a, b) for k, a, b, t, *_ in own if k == cp.OTHER and t.lower() in known]
        write = lambda s: ",".join(f"{cp.KINDS[k]}:{a}:{b}" for k, a, b in s)
        counts = Counter(k for k, _, _ in base)
        out.append((doc_id, *[counts[k] for k in range(4)], hashlib.sha256(write(base).encode()).hexdigest(), write(sorted(base + more))))
    return out, known


def contexts():
    """Texts in which some contexts always hold addresses and numbers, unseen forms of these among them."""
    rng = random.Random(6)
    out = []
    for i in range(150):
        mail = f"user{i}000123(at)mail.example" if i % 15 == 0 else f"name{i}@localhost" if i % 15 == 1 else f"User{i}@mail{i % 7}.example.com"
        call = f"555-{rng.randint(100, 999)}-{rng.randint(1000, 9999)}" if i % 10 == 3 else f"+1 ({rng.randint(100, 999)}) 555-{rng.randint(1000, 9999)}"
        noise = f"order {rng.randint(10**7, 10**8)} {fixtures.words(rng, 2)}"
        out.append((i, f"{fixtures.words(rng, 5)}. Please write to {mail} at once, or call us on {call} before noon. {noise} {fixtures.words(rng, 5)}", "en", "a", 1))
    return out


TRICKY = [
    "a@b.c.d_x@y.z", "a@b.c..d@e.f", "a@b.c@d.e", "@b.c", "a@b", ".a@b.c", "a@b.c.", "x@1.2.3.4", "a@b-.c-", "é@b.c", "a%+b@c.de@f.gh",
    "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.1", "1.2.3", "0001.02.3.255", "01.2.3.4444 9", "1.2.3.4.5", "12.1.2.3.4",
    "4111 1111 1111 1111", "4111-1111-1111-1111", "4111  1111 1111 1111", "4111 1111 1111 1112", "x4111111111111111y", "4111111111111111 0", "0 4111111111111111", "6304000000000000000", "4-1 1-1 1-1 1-1 1-1 1-1 1-1 1-1",
    "+1 (234) 555-1234", "+123", "+1234567890123456", "+1 2 3 4 5 6 7 8 +9 8 7 6 5 4 3 2 1 ", "++1 23456789", "+1 (2", "😀 +49 30 123456 é a@b.co",
    "1 2 3 4 5 6 " * 3000, "12345" * 4000, "a" * 20000 + "@", "x@" + "a." * 3500 + "b_c@d.e", "x@" + ".".join("abc" for _ in range(1000)) + "@q.r", "x@" + "a." * 1001 + ".b@c.d", "." * 5000 + "1.1.1.1",
]


def test_base_spans(spark):
    data = [(i, t, "en", "a", 1) for i, t in enumerate(TRICKY)] + [(500, "1.1.1.1", "en", "a", 1), (500, "a@b.c", "en", "a", 1), (500, "a@b.c", "en", "a", 1), (None, "a@b.c", "en", "a", 1), (501, None, "en", "a", 1)]
    got = [tuple(r) for r in cp.personal_data(fixtures.documents(spark, data).repartition(3)).collect()]
    assert Counter(got) == Counter(brute(data)[0])


def test_contexts_reveal_identifiers(spark):
    data = contexts() + fixtures.rows()
    want, known = brute(data)
    got = [tuple(r) for r in cp.personal_data(fixtures.documents(spark, data).repartition(3)).collect()]
    assert Counter(got) == Counter(want)
    kinds = Counter(k for k, _ in known.values())
    assert kinds[0] == 20 and kinds[3] == 15 and not any(re.fullmatch("[0-9]+", i) for i in known)


def test_no_documents(spark):
    assert cp.personal_data(fixtures.documents(spark, [])).count() == 0
    only_null = [tuple(r) for r in cp.personal_data(fixtures.documents(spark, [(1, None, None, None, None)])).collect()]
    assert only_null == [(1, 0, 0, 0, 0, hashlib.sha256(b"").hexdigest(), "")]
