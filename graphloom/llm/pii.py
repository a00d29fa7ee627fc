"""Personal data: patterns with checks, and a character tagger that also finds what patterns miss.

The tagger is a bidirectional LSTM over characters whose scores go through a CRF with learned transitions. It is trained
here, in numpy, from generated text with labelled spans. Texts are cut into overlapping windows, each read by the LSTM;
every character takes its scores from the window that holds it nearest its middle, and one Viterbi path runs over all
joined windows, so spans of different windows are reconciled before there are any, and a span may cross as many as it
likes. Windows without an anchor are only read where a span runs into them.
"""

from __future__ import annotations

import functools
import hashlib
import random
import re
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .spans import Cover, digest_text

KINDS = ("email", "ip", "card", "phone")

# --- patterns -------------------------------------------------------------------------------------------------

_LOCAL = frozenset(string.ascii_letters + string.digits + "._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Possessive runs and look-behinds find the same matches as the plain patterns without trying each tail of a run.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9]){11,}")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(number: str) -> bool:
    total = 0
    for place, x in enumerate(map(int, reversed(number))):
        total += x if place % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """A match holds exactly one @, so it is enough to look around each, not before the end of the last match."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            end = host.end()
            found.append((start, end))
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(a, b, "email") for a, b in emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(x := part.lstrip("0")) <= 3 and int(x or 0) <= 255 for part in m[0].split(".")):
                found.append((m.start(), m.end(), "ip"))
        for m in _CARD.finditer(text):
            number = _NOT_DIGIT.sub("", m[0])
            if len(number) <= 19 and luhn(number):
                found.append((m.start(), m.end(), "card"))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append((m.start(), m.end(), "phone"))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(found, key=lambda s: (s[0], order[s[2]]))


# --- tagger ---------------------------------------------------------------------------------------------------

HIDDEN = 16
WINDOW = 192
STRIDE = 128
#: In the overlap of two windows the first half belongs to the first.
EDGE = (WINDOW - STRIDE) // 2
#: Label 0 is outside; kind k begins with 1 + 2 k and goes on with 2 + 2 k.
LABELS = 1 + 2 * len(KINDS)
#: A rule beside the tagger: what it finds must hold one of these, and only windows near one are read.
ANCHOR = re.compile(r"[0-9@]|[(\[{] ?[aA][tT] ?[)\]}]")
SPELLED = re.compile(r"\b[dD][oO][tT]\b")
ASCII = 95
CLASSES = ASCII + 4
TRAIN = {"steps": 400, "batch": 48, "length": 96, "rate": 0.02, "seed": 11}


def classes(text: str) -> np.ndarray:
    """A number for each character: printable ASCII as it is, then other letters, white space, digits, the rest."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    out = codes - 32
    odd = np.flatnonzero((codes < 32) | (codes > 126))
    out[odd] = [ASCII + (0 if (c := text[i]).isalpha() else 1 if c.isspace() else 2 if c.isdigit() else 3) for i in odd.tolist()]
    return out


_SYLLABLES = "an er on th in re he ti ou st ha ing ed nd le de que ent es la en ch der die und sch ge ver ung ción os as el ra do è é ê ä ü ß ñ í".split()


def _word(rng) -> str:
    return "".join(rng.choices(_SYLLABLES, k=rng.randrange(1, 5)))


def _number(rng, n: int) -> str:
    return "".join(rng.choices("0123456789", k=n))


def _card(rng) -> str:
    body = _number(rng, rng.choice([12, 13, 14, 15, 15, 15, 15]))
    whole = next(body + str(d) for d in range(10) if luhn(body + str(d)))
    sep = rng.choice(["", "", " ", "-", ".", "/"])
    return sep.join(whole[i : i + 4] for i in range(0, len(whole), 4)) if sep else whole


def _email(rng) -> str:
    name = "".join(rng.choices(string.ascii_lowercase, k=rng.randrange(2, 9)))
    local = [name, f"{name}.{rng.randrange(1, 99)}", f"{name}_{_number(rng, 2)}", f"{name}+{name[:2]}"][rng.randrange(4)]
    host = ["example", "mail", "post", "host", f"mail{rng.randrange(10)}.example"][rng.randrange(5)]
    top = rng.choice(["com", "org", "net", "de", "fr", "es", "io"])
    at, dot = [("@", "."), ("@", "."), ("@", "."), (" (at) ", "."), ("(at)", "(dot)"), (" [At] ", " [dot] "), (" @ ", "."), (" at ", " dot "), (" at ", " dot "), (" AT ", " DOT ")][rng.randrange(10)]
    if at.strip().lower() == "at":
        local, host = local.replace(".", dot), host.replace(".", dot)
    return f"{local}{at}{host}{dot}{top}"


def _phone(rng) -> str:
    a, b, c = _number(rng, 3), _number(rng, 3), _number(rng, 4)
    forms = [f"+1 ({a}) {b}-{c}", f"+{rng.randrange(1, 99)} {a} {b} {c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{rng.randrange(20, 60)} {a} {b}{c}", f"+{rng.randrange(20, 60)}{a}{b}{c}", f"0{a[:2]} {b}{c[:3]} {c}"]
    return forms[rng.randrange(len(forms))]


def _ip(rng) -> str:
    parts = [str(rng.randrange(256)) for _ in range(4)]
    return [".".join(parts), ".".join(parts), "[.]".join(parts), " . ".join(parts)][rng.randrange(4)]


_MAKE = {"email": _email, "ip": _ip, "card": _card, "phone": _phone}


def _harmless(rng) -> str:
    """What looks alike and is none: years, dates, prices, versions, measures, digests, keys."""
    hexes = "".join(rng.choices("0123456789abcdef", k=rng.randrange(16, 64)))
    forms = [
        str(rng.randrange(1, 3000)), f"{rng.randrange(1900, 2100)}-{rng.randrange(1, 13):02}-{rng.randrange(1, 29):02}", f"{rng.randrange(1, 29)}.{rng.randrange(1, 13)}.{rng.randrange(1990, 2030)}",
        f"{rng.randrange(1, 99)}.{_number(rng, 2)}", f"v{rng.randrange(10)}.{rng.randrange(20)}.{rng.randrange(20)}", f"{rng.randrange(1, 999)},{_number(rng, 3)}", f'token = "{hexes}"', hexes,
        f"{rng.randrange(1, 100)}%", f"({rng.randrange(1, 50)})", f"Version {rng.randrange(1, 9)}.0", _number(rng, rng.randrange(5, 8)), f"@{_word(rng)}", f"#{rng.randrange(1, 9999)}", f"{rng.randrange(24)}:{_number(rng, 2)}",
        _number(rng, rng.randrange(20, 40)), f"AKIA{hexes[:16].upper()}", f"[{rng.randrange(1, 99)}]", f"{_word(rng)}{rng.randrange(100)}",
    ]
    return forms[rng.randrange(len(forms))]


def labelled(rng, length: int) -> tuple[str, list[tuple[int, int, str]]]:
    """Generated text of ``length`` characters with the spans of its personal data."""
    text, spans = "", []
    style = rng.randrange(4)
    while len(text) < length + 40:
        pick = rng.random()
        if pick < 0.13:
            kind = KINDS[rng.randrange(len(KINDS))]
            made = _MAKE[kind](rng)
            spans.append((len(text), len(text) + len(made), kind))
            text += made
        elif pick < 0.27:
            text += _harmless(rng)
        else:
            word = _word(rng)
            text += [word, word.capitalize(), word, word.upper()][rng.randrange(4) if style == 3 else (rng.random() < 0.1) * 1]
        text += rng.choice([" ", " ", " ", " ", ", ", ". ", "\n", " | ", "### "])
    start = rng.randrange(40)
    cut = text[start : start + length]
    return cut, [(a - start, b - start, k) for a, b, k in spans if a >= start and b <= start + length]


def tags(spans, length: int) -> np.ndarray:
    out = np.zeros(length, dtype=np.int64)
    for a, b, kind in spans:
        k = KINDS.index(kind)
        out[a:b] = 2 + 2 * k
        out[a] = 1 + 2 * k
    return out


def _sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _lstm(x: np.ndarray, p: dict, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states [2, T, B, H] of both directions for classes x [B, T]; the second reads from the end.

    Only training keeps what every step computed.
    """
    both = np.stack([x.T, x.T[::-1]])
    t_n, b_n = x.shape[1], x.shape[0]
    h = c = np.zeros((2, b_n, HIDDEN), dtype=np.float32)
    side = np.arange(2)[:, None]
    states, kept = np.empty((2, t_n, b_n, HIDDEN), dtype=np.float32), []
    for t in range(t_n):
        z = p["emb"][side, both[:, t]] + h @ p["rec"]
        gates = _sigmoid(z[..., : 3 * HIDDEN])
        i, f, o = gates[..., :HIDDEN], gates[..., HIDDEN : 2 * HIDDEN], gates[..., 2 * HIDDEN :]
        g = np.tanh(z[..., 3 * HIDDEN :])
        old = c
        c = f * c + i * g
        s = np.tanh(c)
        if keep:
            kept.append((h, old, i, f, o, g, s))
        h = o * s
        states[:, t] = h
    return states, kept


def scores(x: np.ndarray, p: dict, keep: bool = False) -> tuple[np.ndarray, np.ndarray, list]:
    """Label scores [T, B, LABELS], the states they come from, and what training keeps."""
    states, kept = _lstm(x, p, keep)
    joined = np.concatenate([states[0], states[1][::-1]], axis=2)
    return joined @ p["out"] + p["bias"], joined, kept


def _crf(e: np.ndarray, y: np.ndarray, p: dict) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
    """Mean negative log-likelihood of labels y [T, B] and its gradients by scores, transitions and start.

    Forward and backward sums are kept as probabilities, scaled at each step; the scales give the likelihood.
    """
    t_n, b_n, n = e.shape
    top = e.max(axis=2, keepdims=True)
    score, trans = np.exp((e - top).astype(np.float64)), np.exp(p["trans"].astype(np.float64))
    alpha, beta, scale = np.empty_like(score), np.ones_like(score), np.empty((t_n, b_n, 1))
    for t in range(t_n):
        a = score[t] * (alpha[t - 1] @ trans if t else np.exp(p["start"].astype(np.float64)))
        scale[t] = a.sum(axis=1, keepdims=True)
        alpha[t] = a / scale[t]
    for t in range(t_n - 2, -1, -1):
        beta[t] = (score[t + 1] * beta[t + 1]) @ trans.T / scale[t + 1]
    z = (np.log(scale) + top).sum(axis=(0, 2))
    grad = alpha * beta
    later = (score[1:] * beta[1:] / scale[1:]).reshape(-1, n)
    pairs = trans * (alpha[:-1].reshape(-1, n).T @ later)
    np.add.at(pairs, (y[:-1].ravel(), y[1:].ravel()), -1)
    t, b = np.indices(y.shape)
    gold = e[t, b, y].sum(0) + p["trans"][y[:-1], y[1:]].sum(0) + p["start"][y[0]]
    grad[t, b, y] -= 1
    first = grad[0].sum(axis=0)
    return float((z - gold).mean()), (grad / b_n).astype(np.float32), (pairs / b_n).astype(np.float32), (first / b_n).astype(np.float32)


def _gradients(x, y, p) -> tuple[float, dict]:
    e, joined, kept = scores(x, p, keep=True)
    loss, ge, gt, gs = _crf(e, y.T, p)
    grads = {"trans": gt, "start": gs, "bias": ge.sum(axis=(0, 1)), "out": joined.reshape(-1, 2 * HIDDEN).T @ ge.reshape(-1, LABELS)}
    gj = ge @ p["out"].T
    gh_all = np.stack([gj[..., :HIDDEN], gj[::-1, :, HIDDEN:]])
    both = np.stack([x.T, x.T[::-1]])
    t_n, b_n = x.shape[1], x.shape[0]
    gz, before = np.empty((2, t_n, b_n, 4 * HIDDEN), dtype=np.float32), np.empty((2, t_n, b_n, HIDDEN), dtype=np.float32)
    gh = gc = np.zeros_like(gh_all[:, 0])
    back = p["rec"].transpose(0, 2, 1)
    for t in range(t_n - 1, -1, -1):
        h, old, i, f, o, g, s = kept[t]
        gh = gh + gh_all[:, t]
        gc = gc + gh * o * (1 - s * s)
        now = gz[:, t]
        now[..., :HIDDEN] = gc * g * i * (1 - i)
        now[..., HIDDEN : 2 * HIDDEN] = gc * old * f * (1 - f)
        now[..., 2 * HIDDEN : 3 * HIDDEN] = gh * s * o * (1 - o)
        now[..., 3 * HIDDEN :] = gc * i * (1 - g * g)
        before[:, t] = h
        gh = now @ back
        gc = gc * f
    grads["rec"] = np.stack([before[d].reshape(-1, HIDDEN).T @ gz[d].reshape(-1, 4 * HIDDEN) for d in range(2)])
    seen = np.arange(CLASSES)[:, None]
    grads["emb"] = np.stack([(both[d].ravel() == seen).astype(np.float32) @ gz[d].reshape(-1, 4 * HIDDEN) for d in range(2)])
    return loss, grads


@functools.cache
def train(steps: int = TRAIN["steps"], batch: int = TRAIN["batch"], length: int = TRAIN["length"], rate: float = TRAIN["rate"], seed: int = TRAIN["seed"]) -> dict:
    """Parameters fitted by Adam to generated text; the same ones every time, whatever the corpus."""
    rng, text = np.random.default_rng(seed), random.Random(seed)
    p = {
        "emb": rng.normal(0, 0.3, (2, CLASSES, 4 * HIDDEN)), "rec": rng.normal(0, 0.25, (2, HIDDEN, 4 * HIDDEN)), "out": rng.normal(0, 0.3, (2 * HIDDEN, LABELS)),
        "bias": np.zeros(LABELS), "trans": np.zeros((LABELS, LABELS)), "start": np.zeros(LABELS),
    }
    p["emb"][..., HIDDEN : 2 * HIDDEN] += 1  # remember, to begin with
    p = {k: v.astype(np.float32) for k, v in p.items()}
    first, second = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}
    for step in range(1, steps + 1):
        made = [labelled(text, length) for _ in range(batch)]
        x, y = np.stack([classes(t) for t, _ in made]), np.stack([tags(s, length) for _, s in made])
        _, grads = _gradients(x, y, p)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
        now = rate * min(1.0, step / 20) * (0.05 + 0.95 * (1 - step / steps))
        for k, g in grads.items():
            g = g * min(1.0, 5.0 / max(norm, 1e-9))
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.99 * second[k] + 0.01 * g * g
            p[k] = (p[k] - now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    for k in range(len(KINDS)):  # a span goes on only from its own kind
        others = [x for x in range(LABELS) if x not in (1 + 2 * k, 2 + 2 * k)]
        p["trans"][others, 2 + 2 * k] = -1e4
        p["start"][2 + 2 * k] = -1e4
    return p


def viterbi(scored: list[np.ndarray], p: dict) -> list[np.ndarray]:
    """Best labels of each text piece, given its scores [T, LABELS]; pieces of any lengths go step by step together."""
    order = sorted(range(len(scored)), key=lambda k: -len(scored[k]))
    lengths = np.array([len(scored[k]) for k in order])
    best = np.empty((0, LABELS), dtype=np.float32)
    back, ends = [], [0] * len(order)
    active = len(order)
    for t in range(lengths[0] if len(order) else 0):
        while active and lengths[active - 1] <= t:
            active -= 1
            ends[active] = int(best[active].argmax())
        now = np.stack([scored[k][t] for k in order[:active]])
        if t == 0:
            best = now + p["start"]
            continue
        ways = best[:active, :, None] + p["trans"]
        came = ways.argmax(axis=1)
        back.append(came.astype(np.int8))
        best = np.take_along_axis(ways, came[:, None, :], axis=1)[:, 0] + now
    for k in range(active):
        ends[k] = int(best[k].argmax())
    out: list[np.ndarray] = [np.empty(0, np.int8)] * len(order)
    label = np.array(ends, dtype=np.int64)
    paths = [np.empty(n, dtype=np.int8) for n in lengths]
    for t in range((lengths[0] if len(order) else 0) - 1, -1, -1):
        here = int(np.searchsorted(-lengths, -t, side="left"))  # pieces longer than t
        for k in range(here):
            paths[k][t] = label[k]
        if t:
            label[:here] = back[t - 1][np.arange(here), label[:here]]
    for k, n in enumerate(order):
        out[n] = paths[k]
    return out


def anchors(text: str) -> list[tuple[int, int]]:
    """Start and end of each anchor, in no order."""
    found = [m.span() for m in ANCHOR.finditer(text)]
    return found + [m.span() for m in SPELLED.finditer(text)] if "dot" in text.lower() else found


def anchored(text: str) -> list[int]:
    """Numbers of the windows that hold an anchor; window k begins at k * STRIDE."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    wanted = set()
    for start, end in anchors(text):
        low, high = max(0, -(-(end - WINDOW) // STRIDE)), start // STRIDE
        wanted.update(range(low, min(high, last) + 1))
    return sorted(wanted)


#: What a span of each kind must hold to be believed: the other rule beside the tagger.
_NEED = {"email": lambda s: ("@" in s or "at" in s.lower()) and "." in s.lower().replace("dot", "."), "ip": lambda s: 4 <= len(_NOT_DIGIT.sub("", s)) <= 12 and len(re.findall(r"[0-9]+", s)) == 4, "card": lambda s: 12 <= len(_NOT_DIGIT.sub("", s)) <= 19, "phone": lambda s: 7 <= len(_NOT_DIGIT.sub("", s)) <= 15}


def spans_of(labels: np.ndarray) -> list[tuple[int, int, str]]:
    """(start, end, kind) of each span of a label sequence."""
    found = []
    for a in np.flatnonzero(labels % 2 == 1).tolist():
        inner, b = labels[a] + 1, a + 1
        while b < len(labels) and labels[b] == inner:
            b += 1
        found.append((a, b, KINDS[(int(inner) - 2) // 2]))
    return found


class Reader:
    """Scores of windows of some texts, each window read once."""

    def __init__(self, texts: list[str], p: dict, held: int):
        self.texts, self.p, self.held = texts, p, held
        self.known: dict[tuple[int, int], np.ndarray] = {}

    def read(self, windows: list[tuple[int, int]]) -> None:
        missing = [w for w in windows if w not in self.known]
        for low in range(0, len(missing), self.held):
            part = missing[low : low + self.held]
            x = np.full((len(part), WINDOW), ASCII + 1, dtype=np.int64)  # white space after the end
            for row, (n, k) in enumerate(part):
                piece = classes(self.texts[n][k * STRIDE : k * STRIDE + WINDOW])
                x[row, : len(piece)] = piece
            e = scores(x, self.p)[0]
            for row, (n, k) in enumerate(part):
                first = 0 if k == 0 else EDGE
                end = WINDOW - EDGE if k * STRIDE + WINDOW < len(self.texts[n]) else len(self.texts[n]) - k * STRIDE
                self.known[n, k] = e[first:end, row].copy()

    def joined(self, n: int, first: int, last: int) -> np.ndarray:
        return np.concatenate([self.known[n, k] for k in range(first, last + 1)])


def tag(texts: list[str], p: dict, held: int = 1024, everything: bool = False) -> list[list[tuple[int, int, str]]]:
    """Spans of the tagger in each text, in order; ``held`` windows are read at a time.

    Neighbouring windows with anchors make a piece. A piece that a span begins or ends at the edge of, with text
    beyond, is made longer on that side, each time by twice as much, until the span ends before. ``everything`` reads
    all windows, and believes spans without an anchor too.
    """
    reader = Reader(texts, p, held)
    last = [max(0, -(-(len(x) - WINDOW) // STRIDE)) for x in texts]
    open_: list[tuple[int, int, int, int]] = []  # text, first and last window, windows to add next
    for n, x in enumerate(texts):
        for k in range(last[n] + 1) if everything and x else anchored(x):
            if open_ and open_[-1][0] == n and open_[-1][2] == k - 1:
                open_[-1] = (*open_[-1][:2], k, 1)
            else:
                open_.append((n, k, k, 1))
    found: list[set] = [set() for _ in texts]
    while open_:
        reader.read([(n, k) for n, a, b, _ in open_ for k in range(a, b + 1)])
        longer = []
        for (n, a, b, more), labels in zip(open_, viterbi([reader.joined(n, a, b) for n, a, b, _ in open_], p), strict=True):
            left, right = a > 0 and labels[0] > 0, b < last[n] and labels[-1] > 0
            if left or right:
                longer.append((n, max(0, a - more * left), min(last[n], b + more * right), 2 * more))
                continue
            at = a * STRIDE + (EDGE if a else 0)
            found[n].update((at + s, at + e, kind) for s, e, kind in spans_of(labels))
        open_ = longer
    out = []
    for text, spans in zip(texts, found, strict=True):
        cover = Cover()  # pieces that grew may have met
        believed = [x for x in sorted(spans) if (everything or anchors(text[x[0] : x[1]])) and _NEED[x[2]](text[x[0] : x[1]])]
        out.append([x for x in believed if cover.take(x[0], x[1])])
    return out


# --- operator -------------------------------------------------------------------------------------------------

_OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_tagged long, base_sha256 string, spans string"
_TYPES = [pa.int64()] * 6 + [pa.string()] * 2


def all_spans(texts: list[str], p: dict) -> list[tuple[list, list]]:
    """(base spans, base spans and those of the tagger that overlap none) of each text."""
    order = {k: i for i, k in enumerate(KINDS)}
    out = []
    for base, tagged in zip(map(base_spans, texts), tag(texts, p), strict=True):
        cover = Cover(base)
        more = [(a, b, kind) for a, b, kind in tagged if cover.free(a, b)]
        out.append((base, sorted(base + more, key=lambda s: (s[0], order[s[2]]))))
    return out


def _scan(p: dict):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows = []
            for low in range(0, len(ids), 256):
                part = [x or "" for x in texts[low : low + 256]]
                for doc_id, (base, every) in zip(ids[low : low + 256], all_spans(part, p), strict=True):
                    kinds = [k for _, _, k in base]
                    rows.append((doc_id, *(kinds.count(k) for k in KINDS), len(every) - len(base), hashlib.sha256(digest_text(base).encode()).hexdigest(), digest_text(every)))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 8, _TYPES, strict=True)], names=[x.split()[0] for x in _OUT.split(", ")])

    return run


def scan_personal(docs: DataFrame, **training) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (of the base), n_tagged (added by the tagger),
    base_sha256, spans.

    Spans are ``kind:start:end`` in code points, end exclusive. Null and empty texts have none; repeated rows and
    null ids are kept as they come; an empty table gives no rows; columns beyond doc_id and text are ignored.
    """
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_scan(train(**training)), _OUT)
