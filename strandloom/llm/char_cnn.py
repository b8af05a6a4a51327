"""A small character convolutional network in numpy: windows of candidates, training, calibration, scoring.

A candidate of any length is covered to its end by overlapping windows; so are its long parts behind ``=``
and ``/``, with the name or path in front as their context. Every window is scored and the largest counts.
"""

from __future__ import annotations

import random
import re
import string

import numpy as np

LEFT, BODY, RIGHT = 24, 48, 8
WIDTH = LEFT + BODY + RIGHT
_EMBED, _CONV, _FILTERS, _HIDDEN = 8, 5, 24, 16
_PARTS = (slice(0, LEFT), slice(LEFT, LEFT + BODY), slice(LEFT + BODY, WIDTH))
#: Character classes: 0 padding, 1 other, then printable ASCII.
CLASSES = 2 + 95
#: Bounds of the fit: generated labelled findings for weights, calibration and thresholds, and passes over them.
TRAIN_ROWS, HELD_ROWS, EPOCHS = 4000, 2000, 6
#: A class's threshold keeps at least this share of the secrets in the findings it is chosen on.
RECALL = 0.98
#: A candidate has at least so many characters; shorter strings carry too little to tell.
CANDIDATE_MIN = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{CANDIDATE_MIN},}}")
_PART = re.compile(rf"[A-Za-z0-9+_-]{{{CANDIDATE_MIN},}}")
#: Classes of candidates, each with its own threshold.
MIXED, LETTERS = 0, 1


def codes(text: str, left: int, start: int, end: int, stop: int) -> list[int]:
    """Classes of one window: text before ``left``, the characters from ``start`` to ``end``, text after ``stop``."""
    one = lambda s: [ord(c) - 30 if " " <= c <= "~" else 1 for c in s]
    before, body, after = one(text[max(0, left - LEFT) : left]), one(text[start:end]), one(text[stop : stop + RIGHT])
    return [0] * (LEFT - len(before)) + before + body + [0] * (BODY - len(body)) + after + [0] * (RIGHT - len(after))


def pieces(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """What is scored of a candidate: all of it, and its long parts between ``=`` and ``/``."""
    return list(dict.fromkeys([(start, end), *(m.span() for m in _PART.finditer(text, start, end))]))


def steps(start: int, end: int) -> list[tuple[int, int]]:
    """Windows that overlap by half and cover a piece to its end."""
    last = max(start, end - BODY)
    return [(at, min(end, at + BODY)) for at in [*range(start, last, BODY // 2), last]]


def candidate_class(body: str) -> int:
    return MIXED if any(c.isdigit() for c in body) else LETTERS


def findings(n: int, seed: int) -> list[tuple[str, int, int, bool]]:
    """Generated labelled findings (text, start, end, secret): secrets of many shapes, and look-alikes, in prose, code and settings."""
    r = random.Random(seed)
    alnum, lower = string.ascii_letters + string.digits, string.ascii_lowercase
    syllable = lambda: r.choice("bcdfghklmnprstvwz") * (r.random() < 0.9) + r.choice(["a", "e", "i", "o", "u", "ei", "ou", "ie"]) + r.choice(["", "", "n", "r", "s", "t", "l", "ch", "st"])
    word = lambda a=2, b=9: "".join(syllable() for _ in range(b // 2 + 1))[: r.randint(a, b)]
    prose = lambda k: " ".join(word() for _ in range(k))
    pick = lambda chars, a, b: "".join(r.choice(chars) for _ in range(r.randint(a, b)))
    name = lambda: r.choice(["key", "token", "secret", "auth", "password", "apikey", "access_key", "client_secret", "credential", "bearer", "private_key", "TOKEN", "API_SECRET", "pwd"])
    digest = lambda: r.choice(["commit", "sha1", "sha256", "md5", "checksum", "etag", "digest", "revision", "blob", "hash"])
    names = lambda: "_".join(word(4, 10) for _ in range(r.randint(3, 8)))
    path = lambda: "/".join(word(3, 9) for _ in range(r.randint(3, 9)))
    case = lambda x: r.choice([x, x, x.upper(), x.title()])
    out = []
    for _ in range(n):
        secret = r.random() < 0.5
        if secret:
            body = r.choice(
                [
                    lambda: pick("0123456789abcdef", 32, 64),
                    lambda: pick(alnum, 24, 48),
                    lambda: pick(alnum + "+/", 38, 60) + r.choice(["", "=", "=="]),
                    lambda: r.choice(["sk_live_", "ghp_", "xoxb-", "glpat-", "AIza", "pk_test_"]) + pick(alnum, 20, 36),
                    lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16, 16),
                    lambda: "eyJ" + pick(alnum + "-_", 30, 60),
                    lambda: pick(alnum + "-_", 28, 44),
                    lambda: pick(string.ascii_uppercase + "234567", 26, 52),
                    lambda: pick(r.choice([string.ascii_uppercase, lower, string.ascii_letters]), 26, 48),
                    lambda: pick(alnum + "+/", 80, 200),
                ]
            )()
            frame = r.choice([f'{name()} = "', f"{name()}: ", f"{name()}=", f"export {word()}_{name().upper()}=", "Authorization: Bearer ", f'"{name()}": "', f"{name()} ", f"{prose(2)} {name()} is ", f"{name()} => '", f"{prose(2)} ", "\n", f"{case(names())}=", f"{path()}/", f"https://{path()}/", f"{case(names())}=", f"?{word()}={word()}&{word()}="])
            tail = r.choice(['"', "\n", " ", "'", ";", ""])
        else:
            body, frame = r.choice(
                [
                    lambda: ("".join(word(3, 8) for _ in range(r.randint(4, 8))), prose(1) + " "),
                    lambda: ("".join(word(3, 8).capitalize() for _ in range(r.randint(3, 6))), prose(1) + " "),
                    lambda: ("_".join(word(3, 8) for _ in range(r.randint(3, 6))) + pick(string.digits, 1, 3), prose(1) + " "),
                    lambda: ("/".join(word(3, 8) for _ in range(4)) + "/" + pick(string.digits, 2, 4), "https://example.com/"),
                    lambda: ("-".join([pick(string.digits, 4, 4), pick(string.digits, 2, 2), word(5, 9), word(5, 9), word(3, 8)]), "/"),
                    lambda: (pick(string.digits, 20, 32), prose(1) + " "),
                    lambda: (r.choice("=-_+") * r.randint(20, 40), "\n"),
                    lambda: ("-".join(pick("0123456789abcdef", a, a) for a in (8, 4, 4, 4, 12)), r.choice(["id ", "uuid: ", prose(1) + " "])),
                    lambda: (pick("0123456789abcdef", 32, 64), digest() + r.choice([" ", ": ", "=", ":"])),
                    lambda: ("IMG_" + pick(string.digits, 8, 8) + "_" + pick(string.digits, 6, 6) + "_" + word(3, 6), r.choice([" ", "/"])),
                    lambda: (case(names() + "_" + names()) + r.choice(["", "="]), prose(1) + " "),
                    lambda: (path() + "/" + path() + r.choice(["", "/" + pick(string.digits, 1, 6)]), r.choice(["/", prose(1) + " ", "https://"])),
                    lambda: (case("".join(word(3, 8) for _ in range(r.randint(4, 14)))), prose(1) + " "),
                    lambda: (case("-".join(word(3, 8) for _ in range(r.randint(4, 12)))), prose(1) + " /"),
                    lambda: (names() + "=" + word(8, 9) + word(8, 9) + word(8, 9), prose(1) + " "),
                    lambda: (word(2, 4) * r.randint(8, 14) + pick(string.digits, 1, 2), prose(1) + " "),
                ]
            )()
            tail = r.choice([" ", ", ", ". ", "\n", ""])
        left = prose(r.randint(0, 5)) + r.choice([" ", "\n", ". ", ""]) + frame
        text = left + body + tail + prose(r.randint(0, 3))
        out.append((text, len(left), len(left) + len(body), secret))
    return out


def labelled_findings(n: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of generated findings: rows, the finding of each row, labels of the findings, classes of the findings.

    Windows over the name or path in front of a secret are left out: they are neither.
    """
    rows, of, labels, classes = [], [], [], []
    for text, a, b, secret in findings(n, seed):
        found = [m.span() for m in CANDIDATE.finditer(text) if m.start() < b and m.end() > a] or [(a, b)]
        least = min(CANDIDATE_MIN, b - a) - 4
        for start, end in found:
            some = False
            for left, stop in pieces(text, start, end):
                for x, y in steps(left, stop):
                    if not secret or min(y, b) - max(x, a) >= least:
                        rows.append(codes(text, left, x, y, stop))
                        of.append(len(labels))
                        some = True
            if some:
                labels.append(secret)
                classes.append(candidate_class(text[start:end]))
    return np.array(rows, np.int16), np.array(of), np.array(labels, np.float64), np.array(classes)


def largest(z: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The largest logit of each finding (rows of a finding follow each other)."""
    return np.maximum.reduceat(z, np.flatnonzero(np.diff(of, prepend=-1))) if len(of) else np.zeros(0)


def _start(seed: int) -> dict[str, np.ndarray]:
    g = np.random.default_rng(seed)
    make = lambda *s, f: g.normal(0, 1 / np.sqrt(f), s)
    return {
        "e": make(CLASSES, _EMBED, f=_EMBED), "k": make(_CONV * _EMBED, _FILTERS, f=_CONV * _EMBED), "c": np.zeros(_FILTERS),
        "w": make(3 * _FILTERS, _HIDDEN, f=3 * _FILTERS), "b": np.zeros(_HIDDEN), "v": make(_HIDDEN, f=_HIDDEN), "o": np.zeros(1),
    }


def _forward(p: dict, x: np.ndarray) -> tuple:
    e = np.pad(p["e"][x], ((0, 0), (_CONV // 2, _CONV // 2), (0, 0)))
    cols = np.concatenate([e[:, j : j + WIDTH] for j in range(_CONV)], axis=2)
    conv = cols @ p["k"] + p["c"]
    tops = [conv[:, s].argmax(axis=1) + s.start for s in _PARTS]
    pooled = np.concatenate([np.take_along_axis(conv, t[:, None, :], 1)[:, 0] for t in tops], axis=1)
    act = np.maximum(pooled, 0)
    hidden = np.maximum(act @ p["w"] + p["b"], 0)
    return cols, tops, pooled, act, hidden, hidden @ p["v"] + p["o"]


def logits(p: dict, x: np.ndarray) -> np.ndarray:
    return np.concatenate([_forward(p, x[i : i + 512])[-1] for i in range(0, len(x), 512)]) if len(x) else np.zeros(0)


def _gradients(p: dict, x: np.ndarray, y: np.ndarray) -> dict:
    cols, tops, pooled, act, hidden, z = _forward(p, x)
    n = len(x)
    dz = (1 / (1 + np.exp(-z)) - y) / n
    dh = np.outer(dz, p["v"]) * (hidden > 0)
    dp = (dh @ p["w"].T) * (pooled > 0)
    g = {"v": hidden.T @ dz, "o": np.array([dz.sum()]), "w": act.T @ dh, "b": dh.sum(0), "c": dp.reshape(n, 3, _FILTERS).sum((0, 1))}
    g["k"], g["e"] = np.zeros_like(p["k"]), np.zeros_like(p["e"])
    padded = np.pad(x.astype(np.int64), ((0, 0), (_CONV // 2, _CONV // 2)), constant_values=CLASSES)  # no class
    rows = np.arange(n)[:, None]
    for part, t in enumerate(tops):  # only the maxima of each part have a gradient
        d = dp[:, part * _FILTERS : (part + 1) * _FILTERS]
        g["k"] += np.einsum("nfc,nf->cf", cols[rows, t], d)
        back = d[:, :, None] * p["k"].T[None]
        for j in range(_CONV):
            hot = padded[rows, t + j].ravel()
            for e in range(_EMBED):
                g["e"][:, e] += np.bincount(hot, back[:, :, j * _EMBED + e].ravel(), CLASSES + 1)[:CLASSES]
    return g


def _calibrated(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that make the logits' probabilities match the held-out labels (Newton steps)."""
    a, b = 1.0, 0.0
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = q * (1 - q) + 1e-6
        grad = np.array([((q - y) * z).sum() + 1e-3 * a, (q - y).sum()])
        hess = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        a, b = np.array([a, b]) - np.linalg.solve(hess, grad)
    return float(a), float(b)


def fit(seed: int = 7, rows: int = TRAIN_ROWS, held: int = HELD_ROWS, epochs: int = EPOCHS, recall: float = RECALL) -> dict:
    """Train on generated findings; calibrate on a second set and choose each class's threshold on a third.

    A threshold is the highest probability that still keeps ``recall`` of its class's secrets. All sets come
    from one generator, so recall and precision are against that generator.
    """
    x, of, labels, _ = labelled_findings(rows, seed)
    y = labels[of]
    p, g = _start(seed), np.random.default_rng(seed)
    m, s, t = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for _ in range(epochs):
        order = g.permutation(len(x))
        for i in range(0, len(x), 64):
            part = order[i : i + 64]
            t += 1
            for k, d in _gradients(p, x[part], y[part]).items():
                m[k], s[k] = 0.9 * m[k] + 0.1 * d, 0.999 * s[k] + 0.001 * d * d
                p[k] = p[k] - 3e-3 * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
    model = {"weights": p}
    cx, cof, cy, _ = labelled_findings(held, seed + 1)
    model["slope"], model["offset"] = _calibrated(largest(logits(p, cx), cof), cy)
    hx, hof, hy, kinds = labelled_findings(held, seed + 2)
    prob = largest(score(model, hx), hof)
    model["thresholds"] = [float(np.quantile(prob[(hy == 1) & (kinds == c)], 1 - recall, method="lower")) for c in (MIXED, LETTERS)]
    chosen = prob >= np.array(model["thresholds"])[kinds]
    return model | {"recall": float(chosen[hy == 1].mean()), "precision": float(hy[chosen].mean())}


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """Calibrated probabilities that windows hold secrets."""
    return 1 / (1 + np.exp(-np.clip(model["slope"] * logits(model["weights"], x) + model["offset"], -30, 30)))
