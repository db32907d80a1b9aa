"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions that adds spans.

The network is written and trained in numpy from labelled spans; examples are generated with a fixed seed (`examples`), so every
run has the same weights and none of the corpus is learnt. Every kind of span holds a digit, an @ or a spelt-out one ("at" in brackets or
before a spelt-out "dot"): windows that have none, nor a neighbour with one, can't touch a span and are not decoded. Each character takes the
emission of the window in which it lies nearest to the middle, and each run of windows that touch is decoded as one sequence, so spans cross
window borders. A run of more than LONGEST strides is decoded in pieces that overlap by MARGIN strides on either side; a span belongs to
the piece in whose own part it begins, so memory is bounded whatever the text.

The network adds what the patterns don't take: phone numbers without a plus, spelt-out mail addresses, addresses and card numbers
with other separators. An added span touches none of the patterns' spans, has a marginal probability under the CRF of SURE or more at its every
character, and as many digits, parts or the Luhn sum that its kind must have.

Cases: a null text counts as empty; a null doc_id is an id as any other; repeated rows are treated each; an empty table gives no rows; a text of any length is worked
on in whole (only its places with digits or @ cost time); other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import blocks, modest_batches

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE, BATCH, LONGEST, MARGIN, SURE = 64, 32, 512, 256, 4, 0.8
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A digit before a match would have been part of it, so looking behind keeps the scan linear in runs of digits.
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[(\[{] ?at ?[)\]}]|\bat (?=[\w-]+ dot )")
_SPELT = re.compile(r"[\w.%+-]+(@| @ | at | ?[(\[{] ?at ?[)\]}] ?)[\w-]+((\.| dot | ?[(\[{] ?dot ?[)\]}] ?)[\w-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def valid(kind: str, s: str) -> bool:
    """Whether a match counts as a span of its kind."""
    if kind == "ip":
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))
    if kind == "card":
        d = _digits(s)
        return 12 <= len(d) <= 19 and luhn(d)
    return kind == "email" or 9 <= len(_digits(s)) <= 15


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the patterns' spans, by start, then kind."""
    if not text or not _TRIGGER.search(text):
        return []
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        found = _EMAIL.match(text, start) if start < at else None
        if found:
            out.append((start, 0, found.end()))
        floor = found.end() if found else at + 1
        at = text.find("@", floor)
    for kind, pattern in ((1, _IP), (2, _CARD), (3, _PHONE)):
        if kind < 3 or "+" in text:
            out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if valid(KINDS[kind], m[0])]
    return sorted(out)


def joined(spans: list[tuple[int, int, int]]) -> str:
    """kind:start:end of each span, comma-joined."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


# --- the network -------------------------------------------------------------------------------------------------------------


def char_ids(text: str) -> np.ndarray:
    """ASCII as it is; 128 for letters beyond it, 129 for the rest."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    ids = np.minimum(codes, 128).astype(np.uint8)
    far = np.flatnonzero(codes > 127)
    if len(far):
        ids[far] = [128 if text[i].isalpha() else 129 for i in far]
    return ids


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Tagger:
    """Embedding, two LSTMs, a linear layer and a CRF; tags are O and begin/inside of each kind."""

    TAGS = 1 + 2 * len(KINDS)

    def __init__(self, embed: int = 12, hidden: int = 16, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        draw = lambda *s: (rng.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.hidden = hidden
        self.p = {"emb": draw(130, embed) * 4, "out": draw(2 * hidden, self.TAGS), "bias": np.zeros(self.TAGS, np.float32), "trans": np.zeros((self.TAGS, self.TAGS), np.float32), "start": np.zeros(self.TAGS, np.float32)}
        for d in "fb":
            self.p |= {f"x{d}": draw(embed, 4 * hidden), f"h{d}": draw(hidden, 4 * hidden), f"c{d}": np.zeros(4 * hidden, np.float32)}
            self.p[f"c{d}"][hidden : 2 * hidden] = 1

    def allowed(self) -> np.ndarray:
        """A penalty for each pair of tags that can't follow each other, and for inside tags at a start."""
        bad = np.zeros((self.TAGS, self.TAGS), np.float32)
        for k in range(len(KINDS)):
            inside = 2 + 2 * k
            bad[:, inside] = -1e4
            bad[[inside, inside - 1], inside] = 0
        return bad

    def _lstm(self, d: str, steps: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        n, h = self.hidden, np.zeros((steps.shape[1], self.hidden), np.float32)
        c, out, seen = h.copy(), np.empty((*steps.shape[:2], n), np.float32), []
        pre = steps @ self.p[f"x{d}"] + self.p[f"c{d}"]
        for t in range(len(steps)):
            z = pre[t] + h @ self.p[f"h{d}"]
            gates, g = _sigmoid(z[:, : 3 * n]), np.tanh(z[:, 3 * n :])
            i, f, o = gates[:, :n], gates[:, n : 2 * n], gates[:, 2 * n :]
            before, c = c, f * c + i * g
            squashed = np.tanh(c)
            if keep:
                seen.append((h, before, i, f, o, g, squashed))
            h = o * squashed
            out[t] = h
        return out, seen

    def emissions(self, ids: np.ndarray, keep: bool = False):
        """Scores (steps, sequences, tags) of ids (steps, sequences)."""
        x = self.p["emb"][ids]
        forward, seen_f = self._lstm("f", x, keep)
        backward, seen_b = self._lstm("b", x[::-1], keep)
        both = np.concatenate([forward, backward[::-1]], axis=2)
        e = both @ self.p["out"] + self.p["bias"]
        return (e, x, both, seen_f, seen_b) if keep else e

    def viterbi(self, e: np.ndarray) -> np.ndarray:
        """The best tags (steps, sequences) of emissions (steps, sequences, tags)."""
        bad = self.allowed()
        trans, score = self.p["trans"] + bad, e[0] + self.p["start"]
        score[:, 2::2] -= 1e4
        back = np.empty(e.shape, np.int8)
        for t in range(1, len(e)):
            every = score[:, :, None] + trans
            back[t] = every.argmax(1)
            score = every.max(1) + e[t]
        tags = np.empty(e.shape[:2], np.int8)
        tags[-1] = score.argmax(1)
        at = np.arange(e.shape[1])
        for t in range(len(e) - 1, 0, -1):
            tags[t - 1] = back[t, at, tags[t]]
        return tags

    def marginals(self, e: np.ndarray, tags: np.ndarray) -> np.ndarray:
        """The probability of each given tag (steps, sequences), all other tags left open."""
        trans, ahead, back = np.exp(self.p["trans"] + self.allowed()), np.empty_like(e), np.ones_like(e)
        start = self.p["start"] + e[0]
        start[:, 2::2] -= 1e4
        x = np.exp(e - e.max(2, keepdims=True))
        ahead[0] = np.exp(start - start.max(1, keepdims=True))
        for t in range(1, len(e)):  # each step is scaled to a sum of one
            ahead[t] = ahead[t - 1] @ trans * x[t]
            ahead[t] /= ahead[t].sum(1, keepdims=True)
        for t in range(len(e) - 2, -1, -1):
            back[t] = (back[t + 1] * x[t + 1]) @ trans.T
            back[t] /= back[t].sum(1, keepdims=True)
        both = ahead * back
        own = np.take_along_axis(both, tags[:, :, None].astype(np.int64), 2)[:, :, 0]
        return own / both.sum(2)

    def gradients(self, ids: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The mean negative log-likelihood of tags (steps, sequences) and its gradients."""
        e, x, both, *seen = self.emissions(ids, keep=True)
        steps, n, k = e.shape
        trans, total = self.p["trans"], lambda a, axis: (m := a.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(a - m).sum(axis))
        alpha, beta = np.empty_like(e), np.zeros_like(e)
        alpha[0] = e[0] + self.p["start"]
        for t in range(1, steps):
            alpha[t] = total(alpha[t - 1][:, :, None] + trans, 1) + e[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = total(trans + (e[t + 1] + beta[t + 1])[:, None, :], 2)
        z = total(alpha[-1], 1)
        at = np.arange(n)
        gold = self.p["start"][tags[0]] + e[np.arange(steps)[:, None], at, tags].sum(0) + trans[tags[:-1], tags[1:]].sum(0)
        de = np.exp(alpha + beta - z[:, None])
        g = {"start": de[0].sum(0), "trans": np.zeros_like(trans)}
        for t in range(1, steps):
            g["trans"] += np.exp(alpha[t - 1][:, :, None] + trans + (e[t] + beta[t])[:, None, :] - z[:, None, None]).sum(0)
        np.add.at(g["start"], tags[0], -1)
        np.add.at(g["trans"], (tags[:-1].ravel(), tags[1:].ravel()), -1)
        de[np.arange(steps)[:, None], at, tags] -= 1
        g |= {"out": np.einsum("tbh,tbk->hk", both, de), "bias": de.sum((0, 1))}
        dboth = de @ self.p["out"].T
        dx = np.zeros_like(x)
        for d, own, xs in (("f", dboth[:, :, : self.hidden], x), ("b", dboth[::-1, :, self.hidden :], x[::-1])):
            dz = self._lstm_back(d, own, seen["fb".index(d)])
            g |= {f"x{d}": np.einsum("tbe,tbz->ez", xs, dz), f"c{d}": dz.sum((0, 1)), f"h{d}": np.einsum("tbh,tbz->hz", np.stack([s[0] for s in seen["fb".index(d)]]), dz)}
            step = dz @ self.p[f"x{d}"].T
            dx += step if d == "f" else step[::-1]
        g["emb"] = np.zeros_like(self.p["emb"])
        np.add.at(g["emb"], ids, dx)
        return float((z - gold).mean()), {name: v / n for name, v in g.items()}

    def _lstm_back(self, d: str, dout: np.ndarray, seen: list) -> np.ndarray:
        dh, dc = np.zeros_like(dout[0]), np.zeros_like(dout[0])
        dz = np.empty((*dout.shape[:2], 4 * self.hidden), np.float32)
        for t in range(len(dout) - 1, -1, -1):
            _, before, i, f, o, g, squashed = seen[t]
            dh = dh + dout[t]
            dc = dc + dh * o * (1 - squashed**2)
            dz[t] = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)], axis=1)
            dh, dc = dz[t] @ self.p[f"h{d}"].T, dc * f
        return dz

    def learn(self, ids: np.ndarray, tags: np.ndarray, steps: int, batch: int = 32, rate: float = 0.01, seed: int = 3) -> "Tagger":
        """Adam over random batches of examples (columns of ids and tags)."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        for t in range(1, steps + 1):
            some = rng.integers(0, ids.shape[1], batch)
            _, g = self.gradients(ids[:, some], tags[:, some])
            scale = min(1.0, 5.0 / (1e-9 + np.sqrt(sum(float((x**2).sum()) for x in g.values()))))
            for k, x in g.items():
                m[k] = 0.9 * m[k] + 0.1 * scale * x
                v[k] = 0.99 * v[k] + 0.01 * (scale * x) ** 2
                self.p[k] = (self.p[k] - rate * (1 - 0.8 * t / steps) * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
        return self


def passage(rng: np.random.Generator, length: int) -> tuple[str, list[int]]:
    """Generated text and the tag of each character: invented prose with spans of every kind, and with other digits."""
    pick = lambda s: s[rng.integers(len(s))]
    some = lambda s, a, b: "".join(pick(s) for _ in range(rng.integers(a, b + 1)))
    digits, small, mixed = "0123456789", "abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzéèöñüABCDEFGHIJ"

    def card() -> str:
        body = some(digits, 15, 15)
        d = body + next(c for c in digits if luhn(body + c))
        return d if rng.random() < 0.4 else pick([" ", "-", ".", "/", "  ", " - "]).join(d[i : i + 4] for i in range(0, 16, 4))

    def phone() -> str:
        area, rest = some(digits, 3, 3), f"{some(digits, 3, 3)}{pick('-. ')}{some(digits, 4, 4)}"
        return pick(["+1 ", "+44 ", "+49 ", "+1-", ""]) + pick([f"({area}) ", f"{area}-", f"{area} ", f"{area}."]) + rest

    def mail() -> str:
        name, host = some(small, 2, 8) + pick(["", ".", "_", "-"]) + some(small + digits, 1, 5), some(small + digits, 3, 7) + pick([".com", ".example.com", ".org", ".co.uk"])
        form = rng.random()
        if form < 0.6:
            return f"{name}@{host}"
        dot = pick([" dot ", " (dot) ", " [dot] "])
        if form < 0.7:
            return f"{name} at {host.replace('.', ' dot ')}"
        return name + pick([" (at) ", " [at] ", "(at)", "[at]", " @ "]) + (host if form < 0.85 else host.replace(".", dot))

    make = {
        0: mail,
        1: lambda: pick([".", ".", ".", " . ", "[.]", "(.)"]).join(str(rng.integers(0, 256)) for _ in range(4)),
        2: card,
        3: phone,
    }
    other = [lambda: some(digits, 1, 8), lambda: f"{rng.integers(1900, 2100)}-{some(digits, 2, 2)}-{some(digits, 2, 2)}", lambda: some("0123456789abcdef", 20, 40), lambda: f"{some(digits, 1, 3)}.{some(digits, 1, 2)}", lambda: "@" + some(small, 3, 8), lambda: f"v{some(digits, 1, 2)}.{some(digits, 1, 2)}.{some(digits, 1, 2)}", lambda: some(digits, 20, 30), lambda: f"at {some(small, 2, 6)}", lambda: f"dot {some(small, 2, 6)}", lambda: f"{some(small, 2, 6)} @ {some(digits, 1, 3)}", lambda: "/".join(some(digits, 2, 4) for _ in range(3)), lambda: f"{some(digits, 1, 2)}:{some(digits, 2, 2)}", lambda: ", ".join(some(digits, 1, 4) for _ in range(3)), lambda: f"{some(digits, 1, 3)} . {some(digits, 1, 3)}"]
    text, tag = "", []
    while len(text) < length:
        r = rng.random()
        kind = int(rng.integers(4)) if r < 0.16 else -1
        piece = make[kind]() if kind >= 0 else pick(other)() if r < 0.28 else some(mixed, 1, 9) + pick(["", "", "", ",", ".", ":"])
        tag += ([1 + 2 * kind] + [2 + 2 * kind] * (len(piece) - 1) if kind >= 0 else [0] * len(piece)) + [0]
        text += piece + pick([" ", " ", " ", "\n"])
    return text, tag


def examples(n: int = 2500, seed: int = 9) -> tuple[np.ndarray, np.ndarray]:
    """Generated windows and their tags, a column each."""
    rng = np.random.default_rng(seed)
    ids, tags = np.empty((WINDOW, n), np.int64), np.zeros((WINDOW, n), np.int64)
    for j in range(n):
        text, tag = passage(rng, 2 * WINDOW)
        at = int(rng.integers(0, WINDOW))
        ids[:, j], tags[:, j] = char_ids(text[at : at + WINDOW]), tag[at : at + WINDOW]
        if tags[0, j] and tags[0, j] % 2 == 0:  # the window begins within a span: its rest begins here
            tags[0, j] -= 1
    return ids, tags


_TRAINED: dict[int, Tagger] = {}


def trained(steps: int = 900) -> Tagger:
    """The tagger for the generated examples; made once in a process."""
    if steps not in _TRAINED:
        _TRAINED[steps] = Tagger().learn(*examples(), steps)
    return _TRAINED[steps]


# --- decoding ----------------------------------------------------------------------------------------------------------------


def _runs(text: str) -> list[tuple[int, int]]:
    """Ranges of stride numbers to decode, [first, last): those with a trigger and their neighbours; ranges that touch are one."""
    out: list[list[int]] = []
    last = -1
    for m in _TRIGGER.finditer(text):
        s = m.start() // STRIDE
        if s == last:
            continue
        last = s
        a, b = max(0, s - 1), min(-(-len(text) // STRIDE), s + 2)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _pieces(runs: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """Runs as pieces (first, last, own first, own last) of stride numbers; those of one run overlap, their own parts don't."""
    return [(max(a, i - MARGIN), min(b, i + LONGEST + MARGIN), i, min(b, i + LONGEST)) for a, b in runs for i in range(a, b, LONGEST)]


def decode(tagger: Tagger, texts: list[str]) -> list[list[tuple[int, int, int]]]:
    """(start, kind number, end) of the network's spans in each text that it is sure of, decoded piece by piece."""
    out: list[list] = [[] for _ in texts]
    waiting: list = []  # (text, piece, ids of its windows)

    def work() -> None:
        lengths: dict[int, list] = {}
        for one in waiting:
            lengths.setdefault(one[1][1] - one[1][0], []).append(one)
        for n, same in lengths.items():
            for at in range(0, len(same), max(1, BATCH // n)):
                part = same[at : at + max(1, BATCH // n)]
                e = tagger.emissions(np.concatenate([x for *_, x in part], axis=1))[STRIDE // 2 : STRIDE // 2 + STRIDE]
                e = e.reshape(STRIDE, len(part), n, -1).transpose(2, 0, 1, 3).reshape(n * STRIDE, len(part), -1)
                tags = tagger.viterbi(e)
                sure = tagger.marginals(e, tags) if tags.any() else None
                for j, (d, (a, _, own, end_of), _) in enumerate(part):
                    for i in np.flatnonzero(tags[:, j] % 2 == 1).tolist():
                        to = i + 1
                        while to < len(tags) and tags[to, j] == tags[i, j] + 1:
                            to += 1
                        if own <= a + i // STRIDE < end_of and sure[i:to, j].min() >= SURE:
                            out[d].append((a * STRIDE + i, int(tags[i, j]) // 2, min(a * STRIDE + to, len(texts[d]))))
        waiting.clear()

    held = 0
    for d, text in enumerate(texts):
        pieces = _pieces(_runs(text))
        if not pieces:
            continue
        # spaces around, so that every stride is the middle of some window
        ids = np.full(len(text) + 3 * STRIDE, 32, np.uint8)
        ids[STRIDE // 2 : STRIDE // 2 + len(text)] = char_ids(text)
        views = np.lib.stride_tricks.sliding_window_view(ids, WINDOW)
        for piece in pieces:
            waiting.append((d, piece, views[piece[0] * STRIDE : piece[1] * STRIDE : STRIDE].T))
            held += piece[1] - piece[0]
            if held >= 8 * BATCH:
                work()
                held = 0
    work()
    return [sorted(x) for x in out]


def all_spans(tagger: Tagger, texts: list[str | None]) -> list[tuple[list, list]]:
    """Of each text the patterns' spans, and these with those that the network adds."""
    base = [base_spans(t) for t in texts]
    some = [i for i, t in enumerate(texts) if t and _TRIGGER.search(t)]
    out = [(b, b) for b in base]
    for i, found in zip(some, decode(tagger, [texts[i] for i in some]), strict=True):
        taken, extra, text, at = base[i], [], texts[i], 0
        reach = np.maximum.accumulate([b for _, _, b in taken]) if taken else []  # up to where the first spans reach
        for start, kind, end in found:
            while end > start and not text[end - 1].isalnum():
                end -= 1
            while start < end and not (text[start].isalnum() or text[start] in "+("):
                start += 1
            while at < len(taken) and taken[at][0] < end:
                at += 1
            clash = at and reach[at - 1] > start or extra and extra[-1][2] > start
            alone = (start == 0 or not text[start - 1].isalnum()) and (end == len(text) or not text[end].isalnum())
            if not clash and alone and _plausible(kind, text[start:end]):
                extra.append((start, kind, end))
        out[i] = (taken, sorted(taken + extra))
    return out


def _plausible(kind: int, s: str) -> bool:
    """Whether a span that the network is sure of has the digits and parts without which it can't be of its kind."""
    if kind == 0:
        return _SPELT.fullmatch(s) is not None
    if kind == 1:
        parts = re.findall(r"[0-9]+", s)
        return len(parts) == 4 and all(len(p) <= 3 and int(p) <= 255 for p in parts) and s.count(".") == 3
    return valid(KINDS[kind], s) and re.search(r"[A-Za-z]", s) is None and (kind == 2 or len(re.findall(r"[0-9]+", s)) >= 3)


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row of docs(doc_id, text)."""
    modest_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trained())
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            cols: list[list] = [[] for _ in range(6)]
            texts = b.column("text").to_pylist()
            for first, last in blocks(texts):
                for base, spans in all_spans(shared.value, texts[first:last]):
                    for k in range(4):
                        cols[k].append(sum(x[1] == k for x in base))
                    cols[4].append(hashlib.sha256(joined(base).encode()).hexdigest())
                    cols[5].append(joined(spans))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=True))], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string")


def mask(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap are replaced as one, by the first's kind."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, kind, end = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][2])
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at, i = end, i + 1
    return "".join([*out, text[at:]])


def masked(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked in their texts, and n_chars, where they have it, as the texts then are."""
    modest_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(trained())

    def run(batches):
        for b in batches:
            texts = b.column("text").to_pylist()
            new = []
            for first, last in blocks(texts):
                some = texts[first:last]
                new += [mask(t, spans) if spans else t for t, (_, spans) in zip(some, all_spans(shared.value, some), strict=True)]
            at = b.schema.get_field_index("text")
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))

    out = docs.mapInArrow(run, T.StructType(docs.schema.fields))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns) if "n_chars" in docs.columns else out
