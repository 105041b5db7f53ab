"""Base spans against the written patterns, the field against exact inference, masks."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from tables import documents, odd_rows, prose, rows_of, saved

from starloom.llm import queries
from starloom.llm import skip_chain_crf as crf

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        odd = [int(d) for d in digits[::-2]]
        even = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
        return 12 <= len(digits) <= 19 and (sum(odd) + sum(even)) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    found = [(m.start(), k, m.end()) for k, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text) if good(kind, m[0])]
    return sorted(found)


def pii_rows():
    texts = [
        "write to ann.b+c@mail.example.com, or a@b.co@d.com and x@y or @z.com a@@b.c.d",
        "hosts 10.0.0.1 and 300.1.1.1, 1.2.3.4.5.6.7.8 v1.2.3 001.002.003.0004 127.0.0.1.",
        "cards 4111 1111 1111 1111 4111-1111-1111-1112 4111111111111111!! 12345678901234567890123",
        "call +1 (706) 555-3138 or +44 20 7946 0958. +1 +12 +(1) +1() +123456789012345678 then 44 20 7946 0958",
        "é 7.7.7.7 ü a.b@c-d.e-f.gh ñ +49 30 1234567 4000-0000-0000-0002", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9",
        "+1 706 555 3138 " * 3 + "and later 706 555 3138 and 1 706 555 3138", "mail ann@localhost and ann@mail.org and ann@localhost",
    ]
    return odd_rows() + [(600 + i, t, "en", "a", None) for i, t in enumerate(texts)]


def test_base_spans_follow_the_patterns():
    for r in pii_rows():
        assert crf.base_spans(r[1] or "") == plain(r[1] or "")


def test_base_spans_of_random_texts():
    draw = random.Random(5)
    for _ in range(6000):
        text = "".join(draw.choice("aZ09917+-. @()%_\n") for _ in range(draw.randrange(60)))
        assert crf.base_spans(text) == plain(text), text
    for _ in range(3000):
        text = "".join(draw.choice(["4111111111111111", "1.1.1.1", " ", "-", ".", "@", "a.b", "+1 ", "(55)", "255", "0"]) for _ in range(draw.randrange(14)))
        assert crf.base_spans(text) == plain(text), text


@pytest.mark.parametrize("text", ["a" * 400_000, "1" * 400_000, "1." * 200_000, "@" * 200_000, "+1(" * 100_000, "a@" * 150_000, "1 " * 200_000])
def test_long_runs_take_linear_time(text):
    crf.base_spans(text)
    blank = crf.Field(np.zeros((crf.N_FEATURES, crf.LABELS)), *np.zeros((2, crf.LABELS, crf.LABELS)))
    crf.added_spans(blank, [text[:50_000]], [crf.base_spans(text[:50_000])])


def test_marginals_are_exact_on_trees():
    draw = np.random.RandomState(0)
    field = crf.Field(draw.normal(size=(crf.N_FEATURES, crf.LABELS)), draw.normal(size=(crf.LABELS,) * 2), draw.normal(size=(crf.LABELS,) * 2))
    features = np.array([1 | 1 << 5 | 1 << 10 | 1 << 1, 1 | 1 << 5, 1 | 1 << 5 | 1 << 10, 1 | 1 << 4 | 1 << 1], np.int64)
    chain, ties = np.array([[0, 1], [1, 2]]), np.array([[0, 0], [1, 2]])
    got = crf.marginals(field, features, chain, ties, [set(), {3, 4}])
    node = np.where(crf.possible(features), crf._bits(features) @ field.node, -40.0)
    want = np.zeros_like(got)
    for y in itertools.product(range(crf.LABELS), repeat=4):
        for h in range(crf.LABELS):
            for g in (3, 4):
                weight = np.exp(sum(node[i, y[i]] for i in range(4)) + field.chain[y[0], y[1]] + field.chain[y[1], y[2]]
                                + field.skip[h, y[0]] - 8 * (h > 0) + field.skip[g, y[2]])
                for i in range(4):
                    want[i, y[i]] += weight
    assert np.abs(got - want / want.sum(1, keepdims=True)).max() < 1e-2


def people(seed, n):
    """Texts that name somebody in a form the patterns know, and what they name, by kind."""
    draw = random.Random(seed)
    out = []
    for _ in range(n):
        digits = "".join(draw.choice("0123456789") for _ in range(10))
        name = "".join(draw.choice("abcdefghijklmnop") for _ in range(6))
        kind, formal = draw.choice([
            (3, f"+1 ({digits[:3]}) {digits[3:6]}-{digits[6:]}"), (3, f"+1{digits}"), (3, f"+44 {digits[:3]} {digits[3:6]} {digits[6:]}"),
            (0, f"{name}.{draw.choice('xyz')}@{draw.choice(['mail', 'post-box', 'inn'])}{draw.randrange(99)}.example.org")])
        filler = prose(draw.randrange(10**6), draw.randrange(5, 60))
        out.append((f"{filler} call {formal} now {draw.randrange(10**4)} of {draw.randrange(10**7, 10**8)} {filler}", kind, formal))
    return out


@pytest.fixture(scope="module")
def trained(spark):
    rows = [(i, text, "en", "a", 0) for i, (text, _, _) in enumerate(people(1, 300))]
    rows += [(1000 + i, f"{prose(i, 40)} {i} and {i * 7919}", "en", "a", 0) for i in range(600)]
    return crf.train(documents(spark, rows))


def test_the_trained_field_finds_second_mentions(trained):
    draw = random.Random(9)
    right = wrong = missed = 0
    for text, kind, formal in people(2, 400):
        for own in (True, False):
            mention = crf.informal(formal if own else crf.stranger(formal, kind, draw), kind, draw)
            longer = f"{text} later {mention} was there"
            base = crf.base_spans(longer)
            at = longer.rindex(mention)
            want = [(at, kind, at + len(mention))] if own and base == crf.base_spans(text) else []
            (added,) = crf.added_spans(trained, [longer], [base])
            right += len(set(want) & set(added))
            wrong += len(set(added) - set(want))
            missed += len(set(want) - set(added))
    assert right > 300 and right / (right + wrong) > 0.9 and right / (right + missed) > 0.9


def test_evidence_reaches_every_occurrence(trained):
    text = "call +15551234567 now, " + "and then 5551234567 again " * 600
    (added,) = crf.added_spans(trained, [text], [crf.base_spans(text)])
    assert added == [(m.start(), 3, m.end()) for m in re.finditer("(?<!1)5551234567", text)]
    backwards = "so 5551234567 came, " * 600 + "call +15551234567 now"
    (added,) = crf.added_spans(trained, [backwards], [crf.base_spans(backwards)])
    assert len(added) == 600


def test_nothing_is_added_without_a_formal_mention(trained):
    text = "order 5551234567 and order 5551234567 and jo.doe@example, jo.doe@example; 4111.1111.1111.1112 and 10.0.0.300"
    assert crf.added_spans(trained, [text], [crf.base_spans(text)]) == [[]]


def test_hubs_grow_with_the_tokens():
    tokens = crf.candidates("5551234 x " * 2000)
    assert len(tokens.spans) == 2000 and not crf.chain_links(tokens)
    assert sum(map(len, crf.hubs(tokens))) == 2 * 2000


@pytest.mark.parametrize("clash", [False, True])
def test_op2(spark, tmp_path, clash):
    folder = saved(tmp_path, documents=documents(spark, pii_rows(), clash))
    got = {}
    for r in queries.op2_skip_chain_crf(spark, folder).collect():
        got.setdefault(r.doc_id, []).append(r)
    names = list(PATTERNS)
    for id_ in {r[0] for r in pii_rows()}:
        texts = sorted(plain_row(r[1] or "", names) for r in pii_rows() if r[0] == id_)
        assert sorted((r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got[id_]) == [t[:5] for t in texts]
    for r in pii_rows():
        mine = [x for x in got[r[0]]]
        base = plain_row(r[1] or "", names)[5]
        assert any(set(base) <= set(x.spans.split(",")) for x in mine)


def plain_row(text, names):
    spans = plain(text)
    listed = [f"{names[k]}:{a}:{b}" for a, k, b in spans]
    counts = [sum(s[1] == k for s in spans) for k in range(4)]
    return (*counts, hashlib.sha256(",".join(listed).encode()).hexdigest(), listed or [""])


def test_mask_replaces_spans_and_nothing_else(spark):
    docs = documents(spark, pii_rows(), clash=True)
    masked = crf.mask(docs, crf.train(docs))
    assert masked.columns == docs.columns
    before, after = rows_of(docs.select("doc_id", "text", "n_chars")), rows_of(masked.select("doc_id", "text", "n_chars"))
    clean = [r for r in before if not re.search("[0-9@]", r[1] or "")]
    assert set(clean) <= set(after) and len(before) == len(after)
    for r in after:
        assert not plain(r[1] or "")
    assert crf.mask(documents(spark, []), crf.train(documents(spark, []))).count() == 0
