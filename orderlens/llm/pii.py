"""Personal data: patterns, and a character-level bidirectional LSTM with CRF transitions that adds to them.

The patterns find e-mail addresses, IP addresses, payment cards and phone numbers as written by the book.
A tagger, trained in numpy on labelled spans, finds other ways of writing them (without the plus, with
other separators, with a spelled-out at sign). Its spans come from the patterns' own matches in a bounded
sample of documents and from rewritten forms of these, beside decoys that are no personal data.

At work the tagger reads the surroundings of every digit and at sign of a text in overlapping windows.
The windows' scores of a character are averaged, those near a window's middle counting most, and one
Viterbi search over the whole stretch reconciles them.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from orderlens.llm.common import id_as_text, id_back, read, unit_hash

KINDS = ("email", "ip", "card", "phone")
#: documents, about, whose pattern matches the tagger is trained on, and examples made of them at most
SAMPLE_ROWS = 4000
SAMPLE_SNIPPETS = 1500
EXAMPLES = 2400
EPOCHS = 6
WINDOW, STRIDE = 64, 32
#: characters read on both sides of a digit or at sign, at least; on to white space, and on while a value reaches the edge
AROUND = 24
EMBEDDING, HIDDEN = 12, 20
BATCH = 2048
SEED = 42

_AT = re.compile(r"@")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# possessive, and only from a run of digits' first: the same matches in linear time
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WHITE = re.compile(r"\s")
_AT_WORD = re.compile(r"@|[(\[]at[)\]]", re.IGNORECASE)
_TRIGGER = re.compile(r"[0-9]+|@|[(\[][Aa][Tt][)\]]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _octets(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _emails(text: str) -> Iterator[Span]:
    end = 0
    for m in _AT.finditer(text):
        at = m.start()
        if at < end:
            continue
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _EMAIL.match(text, start) if start < at else None
        if found:
            end = found.end()
            yield "email", start, end


def base_spans(text: str | None) -> list[Span]:
    """The patterns' spans (kind, start, end) by kind, then start; code points, end exclusive."""
    text = text or ""
    out = list(_emails(text)) if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if _octets(m.group().split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


# the tagger's characters: digits are one, letters lose their case, other signs of ASCII stand for themselves
N_CHARS = 2 + 128


def char_ids(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    upper = (codes >= 65) & (codes <= 90)
    codes = np.where(upper, codes + 32, codes)
    codes = np.where((codes >= 48) & (codes <= 57), 48, codes)
    return np.where(codes < 128, codes + 1, 129)


TAGS = ["O"] + [f"{p}-{k}" for k in KINDS for p in "BI"]
_BAD = np.zeros((len(TAGS), len(TAGS)), bool)  # an inside tag only follows its own kind
for _i, _a in enumerate(TAGS):
    for _j, _b in enumerate(TAGS):
        _BAD[_i, _j] = _b[0] == "I" and _a[2:] != _b[2:]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _lstm(x: np.ndarray, u: np.ndarray, keep: bool):
    """States of an LSTM over projected inputs ``x`` (batch, time, 4 hidden)."""
    n, steps, _ = x.shape
    hidden = u.shape[0]
    h, c = np.zeros((n, hidden), x.dtype), np.zeros((n, hidden), x.dtype)
    out = np.empty((n, steps, hidden), x.dtype)
    saved = []
    for t in range(steps):
        g = x[:, t] + h @ u
        s = _sigmoid(g[:, :3 * hidden])
        i, f, o, z = s[:, :hidden], s[:, hidden:2 * hidden], s[:, 2 * hidden:], np.tanh(g[:, 3 * hidden:])
        before, last = c, h
        c = f * c + i * z
        tc = np.tanh(c)
        h = o * tc
        out[:, t] = h
        if keep:
            saved.append((i, f, o, z, before, tc, last))
    return out, saved


def _lstm_back(d_out: np.ndarray, u: np.ndarray, saved: list):
    n, steps, hidden = d_out.shape
    dx, du = np.empty((n, steps, 4 * hidden), d_out.dtype), np.zeros_like(u)
    dh, dc = np.zeros((n, hidden), d_out.dtype), np.zeros((n, hidden), d_out.dtype)
    for t in reversed(range(steps)):
        i, f, o, z, before, tc, last = saved[t]
        dh = dh + d_out[:, t]
        dc = dc + dh * o * (1 - tc**2)
        dg = np.concatenate([dc * z * i * (1 - i), dc * before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - z**2)], axis=1)
        dx[:, t] = dg
        du += last.T @ dg
        dh = dg @ u.T
        dc = dc * f
    return dx, du


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


@dataclass
class Tagger:
    """Embedding, an LSTM in each direction, a linear layer of tag scores, CRF transitions and starts."""

    weights: dict[str, np.ndarray]

    @classmethod
    def new(cls, rng: np.random.Generator) -> Tagger:
        def w(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        p = {"emb": w(N_CHARS, EMBEDDING) * 3, "out": w(2 * HIDDEN, len(TAGS)), "bias": np.zeros(len(TAGS), np.float32),
             "trans": np.zeros((len(TAGS), len(TAGS)), np.float32), "start": np.zeros(len(TAGS), np.float32)}
        for d in "fb":
            p |= {f"w{d}": w(EMBEDDING, 4 * HIDDEN), f"u{d}": w(HIDDEN, 4 * HIDDEN), f"b{d}": np.zeros(4 * HIDDEN, np.float32)}
            p[f"b{d}"][HIDDEN:2 * HIDDEN] = 1  # remember at first
        return cls(p)

    def emissions(self, ids: np.ndarray) -> np.ndarray:
        """Tag scores of windows of character ids (windows, characters)."""
        p = self.weights
        hs = []
        for d in "fb":
            table = p["emb"] @ p[f"w{d}"] + p[f"b{d}"]
            x = table[ids if d == "f" else ids[:, ::-1]]
            h, _ = _lstm(x, p[f"u{d}"], keep=False)
            hs.append(h if d == "f" else h[:, ::-1])
        return np.concatenate(hs, axis=2) @ p["out"] + p["bias"]

    def moves(self) -> np.ndarray:
        return np.where(_BAD, np.float32(-1e4), self.weights["trans"])

    def starts(self) -> np.ndarray:
        return np.where([t[0] == "I" for t in TAGS], np.float32(-1e4), self.weights["start"])

    def loss(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The CRF's mean negative log likelihood and its gradients."""
        p, n, steps = self.weights, *ids.shape
        xs, hs, saved = {}, {}, {}
        for d in "fb":
            order = ids if d == "f" else ids[:, ::-1]
            xs[d] = p["emb"][order]
            h, saved[d] = _lstm(xs[d] @ p[f"w{d}"] + p[f"b{d}"], p[f"u{d}"], keep=True)
            hs[d] = h if d == "f" else h[:, ::-1]
        both = np.concatenate([hs["f"], hs["b"]], axis=2)
        e = both @ p["out"] + p["bias"]
        moves, starts = self.moves(), self.starts()
        alpha = np.empty_like(e)
        alpha[:, 0] = starts + e[:, 0]
        for t in range(1, steps):
            alpha[:, t] = _logsumexp(alpha[:, t - 1, :, None] + moves, 1) + e[:, t]
        beta = np.zeros_like(e)
        for t in range(steps - 2, -1, -1):
            beta[:, t] = _logsumexp(moves + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
        z = _logsumexp(alpha[:, -1], 1)
        d_e = np.exp(alpha + beta - z[:, None, None])
        pair = np.exp(alpha[:, :-1, :, None] + moves + (e + beta)[:, 1:, None, :] - z[:, None, None, None]).sum(axis=(0, 1))
        rows = np.arange(n)[:, None]
        gold = e[rows, np.arange(steps), tags].sum(1) + starts[tags[:, 0]] + moves[tags[:, :-1], tags[:, 1:]].sum(1)
        g = {"start": d_e[:, 0].sum(0) - np.bincount(tags[:, 0], minlength=len(TAGS))}
        d_e[rows, np.arange(steps), tags] -= 1
        seen = np.zeros_like(pair)
        np.add.at(seen, (tags[:, :-1].ravel(), tags[:, 1:].ravel()), 1)
        g["trans"] = np.where(_BAD, 0, pair - seen)
        g["bias"] = d_e.sum((0, 1))
        g["out"] = both.reshape(-1, 2 * HIDDEN).T @ d_e.reshape(-1, len(TAGS))
        d_both = d_e @ p["out"].T
        g["emb"] = np.zeros_like(p["emb"])
        for d, part in (("f", d_both[..., :HIDDEN]), ("b", d_both[:, ::-1, HIDDEN:])):
            dx, g[f"u{d}"] = _lstm_back(np.ascontiguousarray(part), p[f"u{d}"], saved[d])
            flat = dx.reshape(-1, 4 * HIDDEN)
            g[f"b{d}"] = flat.sum(0)
            g[f"w{d}"] = xs[d].reshape(-1, EMBEDDING).T @ flat
            order = ids if d == "f" else ids[:, ::-1]
            np.add.at(g["emb"], order.ravel(), flat @ p[f"w{d}"].T)
        return float((z - gold).mean()), {k: v / n for k, v in g.items()}

    def fit(self, ids: np.ndarray, tags: np.ndarray, rng: np.random.Generator, epochs: int, rate: float = 0.01, batch: int = 96) -> list[float]:
        """Adam over shuffled batches; the mean loss of each epoch."""
        m = {k: np.zeros_like(v) for k, v in self.weights.items()}
        v = {k: np.zeros_like(x) for k, x in self.weights.items()}
        step, losses = 0, []
        for epoch in range(epochs):
            order, total = rng.permutation(len(ids)), []
            for at in range(0, len(order), batch):
                loss, g = self.loss(ids[order[at:at + batch]], tags[order[at:at + batch]])
                total.append(loss)
                step += 1
                size = max(1.0, float(np.sqrt(sum((x**2).sum() for x in g.values()))) / 5)
                pace = rate * (1 - epoch / (epochs + 1))
                for k, w in self.weights.items():
                    d = (g[k] / size).astype(np.float32)
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.999 * v[k] + 0.001 * d * d
                    w -= (pace * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
            losses.append(float(np.mean(total)))
        return losses

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """The best tags of one stretch of tag scores (characters, tags)."""
        moves = self.moves()
        best, back = self.starts() + e[0], np.empty(e.shape, np.int8)
        for t in range(1, len(e)):
            s = best[:, None] + moves
            back[t] = s.argmax(0)
            best = s.max(0) + e[t]
        tags = np.empty(len(e), np.int64)
        tags[-1] = best.argmax()
        for t in range(len(e) - 1, 0, -1):
            tags[t - 1] = back[t, tags[t]]
        return tags


# --- training spans

#: what stands in for a sample without any match of a kind
SEEDS = {"email": ["jane.doe@example.com", "info@mail.example.org"], "ip": ["192.168.10.25", "83.29.125.7"],
         "card": ["4111111111111111", "5500 0000 0000 0004"], "phone": ["+1 (555) 555-0123", "+49 30 1234567"]}
PLAIN = ["the meeting is on the third floor and all are welcome to come", "please write to us about it when there is time"]


def _digits(rng: np.random.Generator, n: int) -> str:
    return "".join(map(str, rng.integers(0, 10, n)))


def rewritten(kind: str, value: str, rng: np.random.Generator) -> str:
    """Another way to write a value, which the patterns mostly miss."""
    if kind == "email":
        a, _, b = value.partition("@")
        at = rng.choice(["@", " @ ", " (at) ", "(at)", " [at] ", "[at]"])
        dot = rng.choice([".", " . ", " (dot) ", "[dot]", "(dot)"]) if at != "@" else rng.choice([".", " . ", "[dot]"])
        return a + at + b.replace(".", dot)
    if kind == "ip":
        return value.replace(".", rng.choice(["[.]", "(.)", " . ", "."]))
    if kind == "card":
        d = re.sub("[^0-9]", "", value)
        sep = rng.choice([".", "  ", " - ", "/", "_"])
        return sep.join(d[k:k + 4] for k in range(0, len(d), 4))
    d = re.sub("[^0-9]", "", value).zfill(10)[-10:]
    forms = [f"({d[:3]}) {d[3:6]}-{d[6:]}", f"{d[:3]}-{d[3:6]}-{d[6:]}", f"{d[:3]}.{d[3:6]}.{d[6:]}", f"00{d[:2]} {d[2:5]} {d[5:]}",
             f"+{d[:2]}/{d[2:5]}/{d[5:]}", f"({d[:3]}){d[3:6]}-{d[6:]}"]
    return str(rng.choice(forms))


def decoy(rng: np.random.Generator) -> str:
    """Digits and signs that are no personal data."""
    n = int(rng.integers(1, 7))
    forms = [_digits(rng, n), f"{_digits(rng, n)}.{_digits(rng, 2)}", f"v{_digits(rng, 1)}.{_digits(rng, 1)}.{_digits(rng, 1)}",
             f"20{_digits(rng, 2)}-0{_digits(rng, 1)}-1{_digits(rng, 1)}", f"{_digits(rng, 2)}:{_digits(rng, 2)}", f"@{rng.choice(['here', 'all', 'home'])}",
             rng.bytes(int(rng.integers(4, 21))).hex(), f"token = \"{rng.bytes(20).hex()}\"", f"password={rng.bytes(9).hex()}",
             f"{_digits(rng, 2)},{_digits(rng, 3)},{_digits(rng, 3)}", f"{_digits(rng, 1)}/{_digits(rng, 2)}", f"{_digits(rng, 2)}%", f"${_digits(rng, 3)}"]
    return str(forms[int(rng.integers(len(forms)))])


def examples(snippets: list[str], n: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Windows of character ids and their tags, made of snippets with the patterns' matches."""
    found: dict[str, list[str]] = {k: list(v) for k, v in SEEDS.items()}
    plain = list(PLAIN)
    for s in snippets:
        spans = base_spans(s)
        for kind, a, b in spans:
            found[kind].append(s[a:b])
        rest, at = [], 0
        for _, a, b in sorted(spans, key=lambda x: x[1]):
            rest.append(s[at:max(a, at)])
            at = max(b, at)
        rest.append(s[at:])
        plain.append(" ".join(rest))
    ids, tags = np.zeros((n, WINDOW), np.int64), np.zeros((n, WINDOW), np.int64)
    for row in range(n):
        text, marks = "", []
        base = _DIGIT.sub("", plain[int(rng.integers(len(plain)))])
        cut = int(rng.integers(0, max(1, len(base) - 10)))
        text = base[cut:cut + int(rng.integers(0, 40))]
        for _ in range(int(rng.integers(1, 4))):
            kind = KINDS[int(rng.integers(4))]
            glue = rng.choice([" ", " ", " ", ", ", ": ", "\n", "(", ""]) if text else ""
            text += str(glue)
            if rng.random() < 0.4:
                text += decoy(rng)
            else:
                value = found[kind][int(rng.integers(len(found[kind])))]
                if rng.random() < 0.6:
                    value = rewritten(kind, value, rng)
                marks.append((kind, len(text), len(text) + len(value)))
                text += value
            cut = int(rng.integers(0, max(1, len(base) - 10)))
            text += str(rng.choice([" ", " ", ". ", ", ", ")", "\n"])) + base[cut:cut + int(rng.integers(0, 30))]
        start = int(rng.integers(0, max(1, len(text) - WINDOW + 1)))
        part = text[start:start + WINDOW]
        ids[row, :len(part)] = char_ids(part)
        for kind, a, b in marks:
            for k in range(max(a, start), min(b, start + len(part))):
                tags[row, k - start] = TAGS.index(("B-" if k == a or k == start else "I-") + kind)
    return ids, tags


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = SEED) -> Tagger:
    """A tagger from the patterns' matches in a hash sample of about ``sample_rows`` documents. At most
    ``SAMPLE_SNIPPETS`` short snippets come to the driver."""
    n = docs.count()

    def snippets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for u, text in zip(b["u"], b["text"], strict=True):
                spans = base_spans(text)
                for k, (_, x, y) in enumerate(spans):
                    out.append((u + k * 1e-9, text[max(0, x - 40):y + 40]))
            if out:
                yield pd.DataFrame(out, columns=["u", "snippet"])

    u = unit_hash(seed, F.col("doc_id"), F.col("text"))
    sample = docs.select(u.alias("u"), "text").filter((F.col("u") < sample_rows / max(n, 1)) & F.col("text").isNotNull())
    got = sample.mapInPandas(snippets, "u double, snippet string").orderBy("u", "snippet").limit(SAMPLE_SNIPPETS).collect()
    rng = np.random.default_rng(seed)
    ids, tags = examples([r["snippet"] for r in got], EXAMPLES, rng)
    tagger = Tagger.new(rng)
    tagger.fit(ids, tags, rng, EPOCHS)
    return tagger


# --- at work

def _left_space(text: str, at: int, least: int = 0) -> int:
    """The next place at or before ``at`` that is behind white space, at least ``least``."""
    at = max(at, least)
    while at > least and not text[at - 1].isspace():
        at -= 1
    return at


def _right_space(text: str, at: int) -> int:
    """The next place at or behind ``at`` that is before white space, or the end of the text."""
    if at >= len(text):
        return len(text)
    m = _WHITE.search(text, at)
    return m.start() if m else len(text)


def stretches(text: str) -> list[tuple[int, int]]:
    """The parts of a text around digits and at signs, from white space to white space; those that touch are one."""
    out: list[tuple[int, int]] = []
    for m in _TRIGGER.finditer(text):
        if out and m.end() + AROUND <= out[-1][1]:
            continue
        a = _left_space(text, m.start() - AROUND, out[-1][1] if out else 0)
        b = _right_space(text, m.end() + AROUND)
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], b
        else:
            out.append((a, b))
    return out


def _windows(n: int) -> list[int]:
    """Starts of the overlapping windows of a stretch of ``n`` characters."""
    return [0] if n <= WINDOW else [*range(0, n - WINDOW, STRIDE), n - WINDOW]


_MIDDLE = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(np.float32)[:, None]


def tag_stretches(tagger: Tagger, parts: list[str]) -> list[np.ndarray]:
    """The tags of whole stretches: averaged scores of their windows, then one search over each."""
    windows = [(k, at) for k, s in enumerate(parts) for at in _windows(len(s))]
    codes = [char_ids(s) for s in parts]
    scores = [np.zeros((len(s), len(TAGS)), np.float32) for s in parts]
    weight = [np.zeros((len(s), 1), np.float32) for s in parts]
    for lo in range(0, len(windows), BATCH):
        some = windows[lo:lo + BATCH]
        ids = np.zeros((len(some), WINDOW), np.int64)
        for r, (k, at) in enumerate(some):
            c = codes[k][at:at + WINDOW]
            ids[r, :len(c)] = c
        for (k, at), e in zip(some, tagger.emissions(ids), strict=True):
            n = min(WINDOW, len(parts[k]) - at)
            scores[k][at:at + n] += e[:n] * _MIDDLE[:n]
            weight[k][at:at + n] += _MIDDLE[:n]
    return [tagger.viterbi(s / w) if len(s) else np.zeros(0, np.int64) for s, w in zip(scores, weight, strict=True)]


def _plausible(kind: str, value: str) -> bool:
    """What a tagged span has to hold to be of its kind."""
    digits = re.sub("[^0-9]", "", value)
    if kind == "email":
        return bool(re.search(r"\w\W*(?:@|[(\[]at[)\]])\W*\w", value, re.IGNORECASE)) and bool(
            re.search(r"\w\W*(?:\.|dot)\W*\w", _AT_WORD.split(value)[-1], re.IGNORECASE))
    if kind == "ip":
        parts = re.findall("[0-9]+", value)
        return len(parts) == 4 and _octets(parts) and not re.search("[A-Za-z]", value)
    if re.search("[A-Za-z]", value):
        return False
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and (len(digits) < 13 or not luhn(digits)) and len(value) > len(digits)


def tagged_spans(tags: np.ndarray, text: str, start: int) -> Iterator[Span]:
    at = 0
    while at < len(tags):
        name = TAGS[tags[at]]
        if name == "O":
            at += 1
            continue
        end = at + 1
        while end < len(tags) and TAGS[tags[end]] == "I-" + name[2:]:
            end += 1
        a, b = start + at, start + end
        while a < b and text[a].isspace():
            a += 1
        while b > a and not (text[b - 1].isalnum()):
            b -= 1
        whole = (a == 0 or not text[a - 1].isalnum()) and (b == len(text) or not text[b:b + 1].isalnum())
        if b > a and whole and _plausible(name[2:], text[a:b]):
            yield name[2:], a, b
        at = end


def find_spans(tagger: Tagger, texts: list[str | None], at_once: int = 2000) -> list[tuple[list[Span], list[Span]]]:
    """For every text the patterns' spans and the spans that the tagger adds, which touch none of them."""
    base = [base_spans(t) for t in texts]
    added: list[list[Span]] = [[] for _ in texts]
    found: dict[int, dict[int, tuple[int, np.ndarray]]] = {}  # text -> start of a stretch -> its end, its tags
    todo = [(k, a, b) for k, t in enumerate(texts) if t for a, b in stretches(t)]
    for lo in range(0, len(todo), at_once):
        some = todo[lo:lo + at_once]
        while some:
            wider: dict[int, list[tuple[int, int]]] = {}
            for (k, a, b), tags in zip(some, tag_stretches(tagger, [texts[k][a:b] for k, a, b in some]), strict=True):
                at = _left_space(texts[k], a - max(AROUND, b - a)) if TAGS[tags[0]] != "O" else a
                end = _right_space(texts[k], b + max(AROUND, b - a)) if TAGS[tags[-1]] != "O" else b
                found.setdefault(k, {})[a] = b, tags
                if (at, end) != (a, b):
                    wider.setdefault(k, []).append((at, end))
            some = []
            for k, more in wider.items():  # what a wider stretch touches is tagged with it
                merged: list[tuple[int, int]] = []
                for a, b in sorted([(a, b) for a, (b, _) in found[k].items()] + more):
                    if merged and a <= merged[-1][1]:
                        merged[-1] = merged[-1][0], max(b, merged[-1][1])
                    else:
                        merged.append((a, b))
                found[k] = {a: found[k][a] for a, b in merged if a in found[k] and found[k][a][0] == b}
                some += [(k, a, b) for a, b in merged if a not in found[k]]
    for k, parts in found.items():
        for a, (_, tags) in sorted(parts.items()):
            for kind, x, y in tagged_spans(tags, texts[k], a):
                if all(y <= p or x >= q for _, p, q in base[k] + added[k]):
                    added[k].append((kind, x, y))
    return list(zip(base, added, strict=True))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def detect(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """Per document: doc_id, counts and digest of the patterns' spans, all spans, and how many were added.

    NULL counts as empty and has no spans; long texts are read whole; repeated rows each get a row; no
    rows: no rows. Columns besides doc_id and text are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(tagger)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = find_spans(sent.value, list(b["text"]))
            out = {"doc_id": b["doc_id"]}
            for kind in KINDS:
                out[f"n_{kind}"] = [sum(s[0] == kind for s in base) for base, _ in found]
            out["base_sha256"] = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found]
            out["spans"] = [written(base + more) for base, more in found]
            out["n_added"] = [len(more) for _, more in found]
            yield pd.DataFrame(out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    found = id_as_text(docs.select("doc_id", "text")).mapInPandas(
        run, f"doc_id string, {counts}, base_sha256 string, spans string, n_added long")
    return id_back(found, kind)


def redacted(text: str | None, spans: list[Span]) -> str | None:
    """The text with each span, or run of spans that overlap, replaced by its kind in brackets."""
    if not spans:
        return text
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced by its kind; all rows and columns stay, NULL stays
    NULL; an ``n_chars`` column, if there is one, is brought up to date."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, sample_rows))

    @pandas_udf("string")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            texts_ = [t if isinstance(t, str) else None for t in s]
            found = find_spans(sent.value, texts_)
            yield pd.Series([redacted(t, base + more) for t, (base, more) in zip(texts_, found, strict=True)], dtype=object)

    out = docs.withColumn("text", clean(docs["text"]))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op6_pii(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return detect(docs, train(docs))
