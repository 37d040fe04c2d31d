"""Secrets: base spans against an independent search, planted ones behind other words by the field."""

import random
import re
import string

import pytest

from garimpo.llm import secret_tags

WORDS = ["the", "order", "was", "sent", "by", "mail1.example.com", "on", "2024-01-05", "with", "Total", "1234567812345678", "and", "Jane"]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def field(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        text = sentence(rng, 40)
        if i % 4 == 0:
            text += f' token = "{"".join(rng.choice("0123456789abcdef") for _ in range(40))}" ' + sentence(rng, 30)
        rows.append((i, text))
    rows += [(900, None), (901, ""), (902, rows[0][1])]
    return secret_tags.learn(spark.createDataFrame(rows, "doc_id long, text string"), sample=300)


def plain_spans(text):
    """The three patterns of the contract, searched one by one."""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m.group(2)) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 32]
    return sorted(found)


def test_base_spans_against_plain_search():
    rng = random.Random(2)
    parts = ["password", "Token", "API_KEY", "apikey", "=", ":", " ", '"', "'", "AKIA", "ABCDEF0123456789", "abcdef12", "0123456789abcdef" * 2,
             "K", "ſecret", "secret", "é", "x", "\n", "--__"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 9)))
        assert [s[:3] for s in secret_tags.base_spans(text)] == plain_spans(text), text


def test_planted_secrets_behind_other_words(spark, field):
    rng = random.Random(3)
    alphabets = [string.ascii_letters + string.digits, string.ascii_uppercase + string.digits, "0123456789abcdef"]
    rows, places = [], {}
    for i in range(120):
        before = sentence(rng, 25)
        if i % 2 == 0:
            value = "".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(18, 30)))
            before += f' {rng.choice(["credential", "bearer", "signature", "auth"])} = "'
            places[i] = (len(before), len(before) + len(value))
            before += value + '"'
        rows.append((i, before + " " + sentence(rng, 25)))
    found = secret_tags.find_secrets(spark.createDataFrame(rows, "doc_id long, text string"), field).collect()
    tagged = {(r.doc_id, s.start, s.end) for r in found for s in r.secrets if s.kind == "tagged"}
    wanted = {(i, *p) for i, p in places.items()}
    hits = tagged & wanted
    assert len(hits) >= 0.85 * len(wanted)  # recall
    assert len(hits) >= 0.95 * len(tagged)  # precision
    for r in found:
        assert [(s.start, secret_tags.KINDS.index(s.kind), s.end) for s in r.secrets if s.kind != "tagged"] == plain_spans(rows[r.doc_id][1])


def test_training_memory_is_bounded():
    """Chains in small groups give the weights of all chains at once."""
    rng = random.Random(4)
    tokens = [secret_tags.Tokens([sentence(rng, n).encode()]) for n in (3, 9, 30, 30, 80)]
    chains = [(t.features, (t.features[:, 0] % 3 == 0).astype(int)) for t in tokens]
    one, many = (secret_tags.Field().train(chains, rounds=5, cells=c) for c in (10**6, 40))
    assert abs(one.emit - many.emit).max() < 1e-9 and abs(one.turn - many.turn).max() < 1e-9


def test_without_secrets_nothing_is_tagged(spark):
    rows = [(1, "no secrets here"), (2, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = secret_tags.report(secret_tags.find_secrets(docs, secret_tags.learn(docs.limit(0)))).collect()
    assert [(r.n_assign, r.n_access, r.n_hex, r.n_tagged, r.spans) for r in out] == [(0, 0, 0, 0, "")] * 2
