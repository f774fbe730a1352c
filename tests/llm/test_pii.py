import hashlib
import random
import re

import numpy as np
import pytest
from loamline.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def brute(text):
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text or "")]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text or "") if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text or ""):
        d = [int(c) for c in m.group() if c.isdigit()]
        total = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append((2, m.start(), m.end()))
    out += [(3, m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text or "") if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


@pytest.fixture(scope="module")
def model():
    return pii.train(steps=120, batch=24)


def test_base_spans_against_plain_patterns():
    r = random.Random(4)
    bits = ["a", "b.c", "@", "@", ".", "1", "25", "256", "+", "-", " ", "(", ")", "4111 1111 1111 1111", "4111111111111111", "é", "_x", "%", "+1 (212) 555-0100", "0000255.1.1.1", "1.2.3.4", "\n", "\t"]
    texts = [None, "", "a@b.c_x@d.e", "a@b.c@d.e", "1.2.3.4.5.6.7.8", "1" * 5000, "a" * 5000 + "@b.c"] + ["".join(r.choice(bits) for _ in range(r.randrange(40))) for _ in range(3000)]
    for t in texts:
        assert pii.base_spans(t) == brute(t), t


def test_gradients():
    m = pii.new_model(3, 3)
    m = pii.Model(m.emb.astype(float), [w.astype(float) for w in m.w], m.out.astype(float), m.trans.astype(float))
    x, y = pii.batch_of(random.Random(1), 2)
    x, y = x[:14], np.where(y[:14] % 2 == 0, 0, y[:14])
    _, grads = pii.loss_and_gradient(m, x, y)
    for p, g in zip(m.parts(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), p.shape)
        old, sides = p[at], []
        for e in (1e-4, -1e-4):
            p[at] = old + e
            sides.append(pii.loss_and_gradient(m, x, y)[0])
        p[at] = old
        assert abs((sides[0] - sides[1]) / 2e-4 - g[at]) < 1e-3 * abs(g[at]) + 1e-6


def test_held_out_spans(model):
    r, hit, wrong, all_ = random.Random(77), 0, 0, 0
    for _ in range(80):
        text, spans = pii.labelled(r, 500)
        want, got = {s for s in spans if s[2] < 480}, {s for s in pii.all_spans(model, [text])[0][1] if s[2] < 480}
        hit, wrong, all_ = hit + len(want & got), wrong + len(got - want), all_ + len(want)
    assert hit > 0.7 * all_ and wrong < 0.3 * all_


def test_query_and_redaction(spark, monkeypatch, model):
    monkeypatch.setattr(pii, "train", lambda: model)
    texts = [None, "", "mail me at jo.do@mail.example.com now", "x " * 100_000 + " 10.0.0.1", "nothing here"] * 2
    docs = spark.createDataFrame([(i, t, "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, spans string, n_chars long")
    got = pii.found_in(docs.select("doc_id", "text")).collect()
    for g in got:
        want = brute(texts[g["doc_id"]])
        assert g["base_sha256"] == hashlib.sha256(pii.joined(want).encode()).hexdigest()
        assert set(filter(None, pii.joined(want).split(","))) <= set(g["spans"].split(","))
    clean = {r["doc_id"]: r for r in pii.redacted(docs).collect()}
    assert clean[2]["text"] == "mail me at [EMAIL] now" and clean[2]["n_chars"] == 22 and clean[0]["text"] is None and clean[4]["text"] == texts[4] and clean[0]["spans"] == "s"
    assert pii.found_in(docs.select("doc_id", "text").limit(0)).count() == 0
