"""Personal data: fixed patterns, and a character model that adds spans.

The model is a bidirectional LSTM over characters with a CRF over BIO tags,
trained in numpy from labelled spans. The labelled texts are made by a seeded
generator: invented prose with e-mail addresses, IP addresses, card numbers and
phone numbers in many notations, and with numbers that are none of these.

Every kind has a digit or an at sign in it, so tags other than O are only
allowed in windows round such characters; elsewhere all tags are O by
definition and nothing needs to be decoded. Windows overlap. A span found in
several windows is taken from the one in which it lies deepest; spans that
touch a window's edge are left to its neighbour; of spans that overlap the one
with the higher margin stays, and spans of the base patterns always stay.

Null and empty texts have no spans. Positions are code points, ends exclusive.
Rows are read each by itself, so repeats and ids don't matter. Texts are read
whole, at any length, some windows at a time.
"""

from __future__ import annotations

import hashlib
import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_texts, table, whole_rows, with_text

KINDS = ("email", "ip", "card", "phone")
WINDOW, OVERLAP, BATCH, TEXT_BYTES = 96, 48, 512, 4_000_000
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
SEED = re.compile(r"[0-9@]")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind and start. A match of no more than one number is found in linear time."""
    out: list[tuple[int, int, int]] = []
    if not text:
        return out
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((0, start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    if SEED.search(text):
        if "." in text:
            out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in (x.lstrip("0")[:4] or "0" for x in m.group().split(".")))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13:
                digits = m.group().replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


# --- the model -------------------------------------------------------------

TAGS = 1 + 2 * len(KINDS)
CLASSES = 24


def classes_of(text: str) -> np.ndarray:
    """Character classes: what matters for numbers and addresses."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS[np.minimum(codes, 128)]


def _class_table() -> np.ndarray:
    out = np.zeros(129, np.int64)
    for c in range(128):
        ch = chr(c)
        out[c] = 1 if ch.isdigit() else 2 if ch in "abcdef" else 3 if ch.islower() else 4 if ch.isupper() else 5 if ch == " " else 6 if ch in "\t\n\r\v\f" else 7
    for i, ch in enumerate("@.-+()/:,=_\"'#%"):
        out[ord(ch)] = 8 + i
    out[128] = 23
    return out


_CLASS = _class_table()
ALLOWED = np.zeros((TAGS, TAGS), bool)  # from tag to tag
for _i in range(TAGS):
    for _j in range(TAGS):
        ALLOWED[_i, _j] = _j == 0 or _j % 2 == 1 or _i in (_j, _j - 1)


@dataclass
class Model:
    emb: np.ndarray  # classes x e
    w: list[np.ndarray]  # forward and backward: (e + h + 1) x 4h
    out: np.ndarray  # (2h + 1) x tags
    trans: np.ndarray  # tags x tags

    def parts(self) -> list[np.ndarray]:
        return [self.emb, *self.w, self.out, self.trans]


def new_model(hidden: int = 24, e: int = 10, seed: int = 5) -> Model:
    r = np.random.default_rng(seed)
    w = [r.normal(0, 0.25, (e + hidden + 1, 4 * hidden)).astype(np.float32) for _ in range(2)]
    for x in w:
        x[-1, hidden : 2 * hidden] = 1
    return Model(r.normal(0, 0.5, (CLASSES, e)).astype(np.float32), w, r.normal(0, 0.2, (2 * hidden + 1, TAGS)).astype(np.float32), np.zeros((TAGS, TAGS), np.float32))


def _sig(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def lstm(x: np.ndarray, w: np.ndarray, keep: list | None = None) -> np.ndarray:
    """x: time x batch x e."""
    n, b, e = x.shape
    h4 = w.shape[1]
    hid = h4 // 4
    h, c = np.zeros((b, hid), np.float32), np.zeros((b, hid), np.float32)
    pre, out = x @ w[:e] + w[-1], np.empty((n, b, hid), np.float32)
    for t in range(n):
        z = pre[t] + h @ w[e:-1]
        g = _sig(z[:, : 3 * hid])
        i, f, o, u = g[:, :hid], g[:, hid : 2 * hid], g[:, 2 * hid :], np.tanh(z[:, 3 * hid :])
        before, c = c, f * c + i * u
        tc = np.tanh(c)
        if keep is not None:
            keep.append((h, before, i, f, o, u, tc))
        h = o * tc
        out[t] = h
    return out


def lstm_back(x: np.ndarray, w: np.ndarray, keep: list, dout: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n, b, e = x.shape
    hid = w.shape[1] // 4
    dh, dc = np.zeros((b, hid), np.float32), np.zeros((b, hid), np.float32)
    dw, dx = np.zeros_like(w), np.empty_like(x)
    for t in range(n - 1, -1, -1):
        h, before, i, f, o, u, tc = keep[t]
        dh = dh + dout[t]
        dc = dc + dh * o * (1 - tc * tc)
        dz = np.concatenate([dc * u * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - u * u)], 1)
        dw[:e] += x[t].T @ dz
        dw[e:-1] += h.T @ dz
        dw[-1] += dz.sum(0)
        dx[t], dh, dc = dz @ w[:e].T, dz @ w[e:-1].T, dc * f
    return dx, dw


def emissions(m: Model, x: np.ndarray) -> np.ndarray:
    v = m.emb[x]
    h = np.concatenate([lstm(v, m.w[0]), lstm(v[::-1], m.w[1])[::-1]], 2)
    return h @ m.out[:-1] + m.out[-1]


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def loss_and_gradient(m: Model, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """x, y: time x batch. Negative log likelihood of the tags under the CRF, by forward and backward sums."""
    n, b = x.shape
    v, kf, kb = m.emb[x], [], []
    h = np.concatenate([lstm(v, m.w[0], kf), lstm(v[::-1], m.w[1], kb)[::-1]], 2)
    em = h @ m.out[:-1] + m.out[-1]
    tr = np.where(ALLOWED, m.trans, -1e4)
    alpha, beta = np.empty_like(em), np.zeros_like(em)
    alpha[0] = em[0]
    for t in range(1, n):
        alpha[t] = _lse(alpha[t - 1][:, :, None] + tr, 1) + em[t]
    for t in range(n - 2, -1, -1):
        beta[t] = _lse(tr + (em[t + 1] + beta[t + 1])[:, None, :], 2)
    z = _lse(alpha[-1], 1)
    dem = np.exp(alpha + beta - z[:, None])
    dtr = np.zeros_like(m.trans)
    for t in range(1, n):
        dtr += np.exp(alpha[t - 1][:, :, None] + tr + (em[t] + beta[t])[:, None, :] - z[:, None, None]).sum(0)
    np.add.at(dtr, (y[:-1].ravel(), y[1:].ravel()), -1)
    gold = np.take_along_axis(em, y[:, :, None], 2).sum() + tr[y[:-1], y[1:]].sum()
    np.put_along_axis(dem, y[:, :, None], np.take_along_axis(dem, y[:, :, None], 2) - 1, 2)
    dout = np.concatenate([np.tensordot(h, dem, ((0, 1), (0, 1))), dem.sum((0, 1))[None]])
    dh = dem @ m.out[:-1].T
    hid = h.shape[2] // 2
    dx1, dw1 = lstm_back(v, m.w[0], kf, dh[:, :, :hid])
    dx2, dw2 = lstm_back(v[::-1], m.w[1], kb, dh[::-1, :, hid:])
    demb = np.zeros_like(m.emb)
    np.add.at(demb, x, dx1 + dx2[::-1])
    return float(z.sum() - gold) / b, [g / b for g in (demb, dw1, dw2, dout, np.where(ALLOWED, dtr, 0))]


def decode(m: Model, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best tags, and by how much each position's score is above O."""
    em = emissions(m, x)
    tr = np.where(ALLOWED, m.trans, -1e4)
    n, b, _ = em.shape
    score, back = em[0].copy(), np.empty((n, b, TAGS), np.int8)
    score[:, 2::2] -= 1e4
    for t in range(1, n):
        every = score[:, :, None] + tr
        back[t] = every.argmax(1)
        score = np.take_along_axis(every, back[t][:, None, :].astype(np.int64), 1)[:, 0] + em[t]
    tags = np.empty((n, b), np.int64)
    tags[-1] = score.argmax(1)
    for t in range(n - 1, 0, -1):
        tags[t - 1] = back[t][np.arange(b), tags[t]]
    return tags, np.take_along_axis(em, tags[:, :, None], 2)[:, :, 0] - em[:, :, 0]


# --- labelled texts --------------------------------------------------------


def _entity(r: random.Random) -> tuple[int, str]:
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    word = lambda: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9)))
    kind = r.randrange(4)
    if kind == 0:
        name = r.choice([word(), word() + "." + d(2), word() + r.choice("._-+") + word(), word() + d(2), word().title() + "." + word().title()])
        return 0, f"{name}@{r.choice([word(), 'mail' + d(1), word() + '-' + word()])}.{r.choice(['com', 'org', 'net', 'de', 'co.uk', 'example.com'])}"
    if kind == 1:
        return 1, ".".join(str(r.randint(0, 255)) for _ in range(4))
    if kind == 2:
        body = r.choice("3456") + d(r.choice([14, 14, 14, 13]))
        full = next(body + c for c in "0123456789" if luhn(body + c))
        gap = r.choice(["", "", " ", "-"])
        return 2, gap.join(full[i : i + 4] for i in range(0, len(full), 4))
    a, b, c = d(3), d(3), d(4)
    return 3, r.choice([f"({a}) {b}-{c}", f"({a}) {b}-{c}", f"({a}){b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+1 ({a}) {b}-{c}", f"+{d(2)} {a} {b} {c}", f"+{d(1)}-{a}-{b}-{c}", f"+{d(1)} {a} {b} {d(2)} {d(2)}", f"00{d(2)} {a} {b}{c}"])


def _decoy(r: random.Random) -> str:
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    h = "".join(r.choice("0123456789abcdef") for _ in range(r.choice([8, 16, 32, 40])))
    return r.choice([d(r.randint(1, 8)), d(r.randint(1, 8)), f"{d(1)}.{d(1)}", f"{d(2)}.{d(2)}", f"{d(1)}.{d(1)}.{d(2)}", f'token = "{h}"', h, "AKIA" + h.upper()[:16], f"20{d(2)}-0{d(1)}-1{d(1)}", f"{d(2)}:{d(2)}", f"{d(2)}/{d(2)}/{d(4)}", f"{d(3)},{d(3)}", f"{d(1)},{d(3)},{d(3)}", f"page {d(2)}-{d(2)}", f"[{d(1)}]", f"({d(4)})", f"({d(1)})", f"@{h[:6]}", f"{d(3)}%", f"${d(2)}.{d(2)}", f"v{d(1)}.{d(1)}.{d(1)}", f"{d(4)}-{d(4)}", f"ISBN {d(3)}-{d(1)}-{d(5)}-{d(3)}-{d(1)}", d(r.randint(11, 14)), d(20), f"{d(3)} {d(3)}", f"{d(4)} {d(4)} {d(2)}"])


def labelled(r: random.Random, length: int) -> tuple[str, list[tuple[int, int, int]]]:
    """A text of the given length and the spans in it."""
    syllables = ["the", "an", "er", "ti", "on", "é", "ou", "de", "la", "sch", "ung", "ción", "ñ", "th", "ea", "Re", "ß", "ing"]
    text, spans = "", []
    while len(text) < length:
        x = r.random()
        if x < 0.10:
            kind, s = _entity(r)
            spans.append((kind, len(text), len(text) + len(s)))
            text += s
        elif x < 0.2:
            text += _decoy(r)
        else:
            text += "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
        text += r.choice([" ", " ", " ", " ", " ", ", ", ". ", "\n", ".\n", "### ", "!! ", "*** ", ": "])
    return text[:length], [s for s in spans if s[1] < length]


def batch_of(r: random.Random, n: int) -> tuple[np.ndarray, np.ndarray]:
    xs, ys = [], []
    for _ in range(n):
        shift = r.randrange(40)
        text, spans = labelled(r, WINDOW + shift)
        y = np.zeros(WINDOW + shift, np.int64)
        for kind, a, b in spans:
            y[a:b] = 2 * kind + 2
            y[a] = 2 * kind + 1
        y = y[shift:]
        xs.append(classes_of(text)[shift:])
        ys.append(y)
    return np.stack(xs, 1), np.stack(ys, 1)


def train(steps: int = 300, batch: int = 40, seed: int = 11) -> Model:
    m, r = new_model(), random.Random(seed)
    mean = [np.zeros_like(p) for p in m.parts()]
    var = [np.zeros_like(p) for p in m.parts()]
    for step in range(1, steps + 1):
        _, grads = loss_and_gradient(m, *batch_of(r, batch))
        norm = float(np.sqrt(sum((g * g).sum() for g in grads)))
        rate = 0.012 * min(1, step / 20) * (1 - 0.95 * step / steps)
        for p, g, a, v in zip(m.parts(), grads, mean, var, strict=True):
            g = g * min(1, 5 / (norm + 1e-9))
            a += 0.1 * (g - a)
            v += 0.005 * (g * g - v)
            p -= rate * (a / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.995**step)) + 1e-7)
    return m


# --- whole texts -----------------------------------------------------------


def windows_of(text: str) -> list[int]:
    """Starts of overlapping windows that cover every digit and at sign with what is round them."""
    starts: list[int] = []
    step = WINDOW - OVERLAP
    for m in SEED.finditer(text):
        first = max(0, m.start() - OVERLAP) // step
        for k in (first, first + 1):
            if (not starts or k * step > starts[-1]) and k * step < len(text):
                starts.append(k * step)
    return starts


SHAPE = {0: re.compile(r"[^\s@]+@[^\s@]+"), 1: re.compile(r"[0-9.]{7,15}"), 2: re.compile(r"[0-9](?:[ -]?[0-9]){12,18}"), 3: re.compile(r"[+(0-9](?:[ ().-]*[0-9]){6,14}")}


def plausible(kind: int, s: str) -> bool:
    """What a span of the model must hold to, whatever its score."""
    if not SHAPE[kind].fullmatch(s):
        return False
    digits = [c for c in s if c.isdigit()]
    if kind == 1:
        parts = s.split(".")
        return len(parts) == 4 and all(p and int(p) <= 255 for p in parts)
    if kind == 2:
        return luhn("".join(digits))
    return kind != 3 or (9 <= len(digits) <= 15 and len(s) > len(digits))


def model_spans(m: Model, texts: list[str | None]) -> list[list[tuple[int, int, int]]]:
    """Spans for each text, reconciled over its windows."""
    jobs = [(i, s) for i, t in enumerate(texts) if t for s in windows_of(t)]
    found: list[list[tuple]] = [[] for _ in texts]
    for k in range(0, len(jobs), BATCH):
        some = jobs[k : k + BATCH]
        x = np.full((WINDOW, len(some)), 6, np.int64)
        for j, (i, s) in enumerate(some):
            c = classes_of(texts[i][s : s + WINDOW])
            x[: len(c), j] = c
        tags, margin = decode(m, x)
        for j in np.nonzero((tags % 2 == 1).any(0))[0]:
            i, s = some[j]
            size = min(WINDOW, len(texts[i]) - s)
            col = tags[:, j]
            a = 0
            while a < size:
                if col[a] % 2 == 1:
                    b = a + 1
                    while b < size and col[b] == col[a] + 1:
                        b += 1
                    edge = (a == 0 and s > 0) or (b == WINDOW and s + WINDOW < len(texts[i]))
                    if not edge:
                        found[i].append((min(a if s else WINDOW, WINDOW - b if s + WINDOW < len(texts[i]) else WINDOW), float(margin[a:b, j].mean()), int(col[a] - 1) // 2, s + a, s + b))
                    a = b
                else:
                    a += 1
    out = []
    for i, spans in enumerate(found):
        taken: list[tuple[int, int, int]] = []
        deepest: dict = {}
        for depth, margin, kind, a, b in spans:
            while a < b and texts[i][a] in " .,-":
                a += 1
            while b > a and texts[i][b - 1] in " .,-(":
                b -= 1
            if a < b and plausible(kind, texts[i][a:b]) and not (a and texts[i][a - 1].isalnum() and texts[i][a].isalnum()) and not (b < len(texts[i]) and texts[i][b].isalnum()):
                deepest[(kind, a, b)] = max(deepest.get((kind, a, b), (0, 0.0)), (depth, margin))
        for (kind, a, b), _ in sorted(deepest.items(), key=lambda x: (-x[1][1], x[0])):
            if all(b <= c or d <= a for _, c, d in taken):
                taken.append((kind, a, b))
        out.append(sorted(taken))
    return out


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def all_spans(m: Model, texts: list[str | None]) -> list[tuple[list, list]]:
    """(base, all) for each text."""
    out = []
    for text, more in zip(texts, model_spans(m, texts), strict=True):
        base = base_spans(text)
        out.append((base, sorted(base + [s for s in more if all(s[2] <= a or b <= s[1] for _, a, b in base)])))
    return out


def replaced(text: str | None, spans: list[tuple[int, int, int]]) -> str | None:
    """The text with each span, or run of spans that overlap, replaced by the name of its first kind."""
    if not spans:
        return text
    out, last = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[0])):
        if a >= last:
            out += [text[last:a], f"[{KINDS[kind].upper()}]"]
        last = max(last, b)
    return "".join(out) + text[last:]


def found_in(docs: DataFrame, clean: bool = False) -> DataFrame:
    """docs with counts, base_sha256 and spans instead of the text; and, if clean, clean_text."""
    model = docs.sparkSession.sparkContext.broadcast(train())

    def make():
        def of(texts: list) -> list:
            rows = []
            for text, (base, every) in zip(texts, all_spans(model.value, texts), strict=True):
                n = [sum(s[0] == k for s in base) for k in range(len(KINDS))]
                row = (*n, hashlib.sha256(joined(base).encode()).hexdigest(), joined(every))
                rows.append((*row, replaced(text, every)) if clean else row)
            return list(zip(*rows, strict=True))

        return of

    out = {f"n_{k}": "long" for k in KINDS} | {"base_sha256": "string", "spans": "string"} | ({"clean_text": "string"} if clean else {})
    return map_texts(docs, make, out, TEXT_BYTES)


def redacted(docs: DataFrame) -> DataFrame:
    return with_text(found_in(whole_rows(docs), clean=True), docs.schema, "clean_text")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return found_in(table(spark, sf_dir, "documents").select("doc_id", F.col("text")))
