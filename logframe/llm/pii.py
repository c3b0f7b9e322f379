"""Personal data in texts: rules, and a character-level bidirectional LSTM with a CRF that adds to them.

The network learns in numpy from windows that the rules have labelled, with
their spans respelled in ways that rules miss. Whole texts are then cut into
overlapping windows, each is decoded by Viterbi, and the spans of all windows
of a text are reconciled with each other and with the rules' spans.
"""

from __future__ import annotations

import bisect
import dataclasses
import hashlib
import re
import string
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logframe.llm.shared import unused
from logframe.operators.rank import top_per_group

# Kinds, in the order that spans of one start are listed in.
KINDS = ("email", "ip", "card", "phone")

# Characters of a window, and between the starts of neighbouring windows.
WINDOW, STRIDE = 64, 32

# Windows that are decoded together.
BATCH = 256

# What each span that is kept has somewhere: windows without it need no decoding.
TRIGGER = re.compile(r"[0-9@]|[(\[]at[)\]]", re.IGNORECASE | re.ASCII)

Span = tuple[str, int, int]

_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# Runs of digits are entered at their start only, so long ones take linear time.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    """Whether the last digit checks the others."""
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _small(part: str) -> bool:
    """A number up to 255, of any length in digits."""
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _card(digits: str) -> bool:
    return 14 <= len(digits) <= 19 and luhn(digits)


def rule_spans(text: str) -> list[Span]:
    """The spans of all rules by start, then kind; those of one kind are leftmost and do not overlap."""
    found: list[Span] = []
    at, end = text.find("@"), 0
    while at >= 0:
        start = end + len(text[end:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append(("email", start, domain.end()))
        end = domain.end() if domain else at + 1
        at = text.find("@", end)
    for match in _IP.finditer(text):
        if all(map(_small, match[0].split("."))):
            found.append(("ip", *match.span()))
    for match in _CARD.finditer(text):
        if match.end() - match.start() < 40 and _card(_digits(match[0])):
            found.append(("card", *match.span()))
    for match in _PHONE.finditer(text):
        if 10 <= len(_digits(match[0])) <= 15:
            found.append(("phone", *match.span()))
    return _sorted(found)


def _sorted(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda span: (span[1], KINDS.index(span[0]), span[2]))


_AT = re.compile(r"(@|[(\[]at[)\]])", re.IGNORECASE)
_DOT = re.compile(r"[a-z0-9]\s?(?:\.|[(\[]dot[)\]])\s?[a-z0-9]", re.IGNORECASE)


def plausible(kind: str, text: str) -> bool:
    """What a span that the network adds must have, whatever its spelling."""
    digits = _digits(text)
    if kind == "email":
        name, mark, host = (re.split(_AT, text, maxsplit=1) + ["", ""])[:3]
        return bool(mark and re.search("[A-Za-z0-9]", name) and re.search(_DOT, host))
    if kind == "ip":
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(map(_small, parts)) and not re.search(r"[^0-9.()\[\]\x20]", text)
    if re.search(r"[^0-9+().\x20/-]", text):
        return False
    if kind == "card":
        return _card(digits)
    return 10 <= len(digits) <= 15 and bool(re.search(r"\(\d+\)|\d[^0-9]+\d+[^0-9]+\d", text))


# Codes of characters: 0 pads; letters in either case, all digits, and other ASCII characters.
_CODE = np.zeros(128, dtype=np.int64)
_CODE[:] = 3
for _n, _c in enumerate(string.ascii_lowercase, start=8):
    _CODE[ord(_c)] = _CODE[ord(_c.upper())] = _n
for _n, _c in enumerate(string.punctuation, start=34):
    _CODE[ord(_c)] = _n
for _c in string.digits:
    _CODE[ord(_c)] = 4
_CODE[[9, 11, 12, 13, 32]] = 5
_CODE[10] = 6
CODES = 34 + len(string.punctuation)

# Tags: 0 outside, then the beginning and the inside of each kind.
TAGS = 1 + 2 * len(KINDS)


def encode(windows: list[str]) -> np.ndarray:
    """The windows' characters as codes, a row each."""
    out = np.zeros((len(windows), WINDOW), dtype=np.int64)
    for i, window in enumerate(windows):
        points = np.frombuffer(window.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        out[i, : len(points)] = np.where(points < 128, _CODE[np.minimum(points, 127)], 7)
    return out


def tag(spans: list[Span], low: int, high: int) -> np.ndarray:
    """Tags of the characters from ``low`` to ``high``; a span that begins before begins there."""
    tags = np.zeros(WINDOW, dtype=np.int64)
    for kind, start, end in reversed(spans):
        start, end = max(start, low), min(end, high)
        if start < end:
            first = 1 + 2 * KINDS.index(kind)
            tags[start - low : end - low] = first + 1
            tags[start - low] = first
    return tags


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


@dataclasses.dataclass(frozen=True)
class Settings:
    """Bounds of the training sample, and how the network learns."""

    windows: int = 300  # per kind, and of windows with a trigger but no span
    units: int = 24
    embedding: int = 12
    epochs: int = 10
    batch: int = 100
    rate: float = 0.01
    seed: int = 13


class Network:
    """A bidirectional LSTM over characters and a CRF over its outputs."""

    def __init__(self, settings: Settings):
        rng = np.random.default_rng(settings.seed)
        e, h = settings.embedding, settings.units
        draw = lambda *shape: rng.normal(0, shape[-2] ** -0.5, shape).astype(np.float32)
        self.weights = {
            "embedding": rng.normal(0, 0.5, (CODES, e)).astype(np.float32),
            "input": draw(2, e, 4 * h),
            "state": draw(2, h, 4 * h),
            "bias": np.zeros((2, 1, 4 * h), np.float32),
            # No outputs at first: an untrained network finds nothing.
            "output": np.zeros((2 * h, TAGS), np.float32),
            "output_bias": np.zeros(TAGS, np.float32),
            "step": np.zeros((TAGS, TAGS), np.float32),
            "start": np.zeros(TAGS, np.float32),
        }
        self.weights["bias"][:, :, h : 2 * h] = 1  # of the forget gate

    def _run(self, codes: np.ndarray) -> dict:
        """Both directions at once; gates are input, forget, output and candidate."""
        w, h = self.weights, len(self.weights["output"]) // 2
        both = np.stack([codes, codes[:, ::-1]])
        inputs = w["embedding"][both]
        drive = inputs @ w["input"][:, None] + w["bias"][:, None]
        n, steps = codes.shape
        state = cell = np.zeros((2, n, h), np.float32)
        kept = {"both": both, "inputs": inputs, "gates": [], "cells": [], "states": [state]}
        for t in range(steps):
            z = drive[:, :, t] + state @ w["state"]
            gates = np.concatenate([_sigmoid(z[..., : 3 * h]), np.tanh(z[..., 3 * h :])], axis=-1)
            kept["gates"].append(gates)
            kept["cells"].append(cell)
            cell = gates[..., h : 2 * h] * cell + gates[..., :h] * gates[..., 3 * h :]
            state = gates[..., 2 * h : 3 * h] * np.tanh(cell)
            kept["states"].append(state)
        kept["cells"].append(cell)
        out = np.stack(kept["states"][1:], axis=2)
        kept["features"] = np.concatenate([out[0], out[1][:, ::-1]], axis=-1)
        kept["scores"] = kept["features"] @ w["output"] + w["output_bias"]
        return kept

    def gradient(self, codes: np.ndarray, tags: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The mean negative log likelihood of the tags, and its gradient."""
        w, run = self.weights, self._run(codes)
        scores, (n, steps) = run["scores"], codes.shape
        forward, backward = [w["start"] + scores[:, 0]], [np.zeros((n, TAGS), np.float32)]
        for t in range(1, steps):
            forward.append(_logsum(forward[-1][:, :, None] + w["step"], 1) + scores[:, t])
            after = backward[0] + scores[:, steps - t]
            backward.insert(0, _logsum(w["step"] + after[:, None, :], 2))
        total = _logsum(forward[-1], 1)
        share = np.exp(np.stack(forward, 1) + np.stack(backward, 1) - total[:, None, None])
        grad = {"step": np.zeros_like(w["step"])}
        for t in range(1, steps):
            after = backward[t] + scores[:, t]
            pair = forward[t - 1][:, :, None] + w["step"] + after[:, None, :] - total[:, None, None]
            grad["step"] += np.exp(pair).sum(0)
        rows, places = np.arange(n)[:, None], np.arange(steps)
        path = scores[rows, places, tags].sum(1) + w["start"][tags[:, 0]]
        path = path + w["step"][tags[:, :-1], tags[:, 1:]].sum(1)
        share[rows, places, tags] -= 1
        np.subtract.at(grad["step"], (tags[:, :-1], tags[:, 1:]), 1)
        grad["start"] = share[:, 0].sum(0)
        grad["output"] = np.einsum("ntf,ntk->fk", run["features"], share, optimize=True)
        grad["output_bias"] = share.sum((0, 1))
        self._back(run, share @ w["output"].T, grad)
        return float((total - path).mean()), {name: g / n for name, g in grad.items()}

    def _back(self, run: dict, of_features: np.ndarray, grad: dict[str, np.ndarray]) -> None:
        w, h = self.weights, len(self.weights["output"]) // 2
        of_out = np.stack([of_features[..., :h], of_features[:, ::-1, h:]])
        of_drive = np.empty((*run["inputs"].shape[:3], 4 * h), np.float32)
        grad["state"] = np.zeros_like(w["state"])
        of_state = of_cell = np.zeros_like(run["states"][0])
        for t in reversed(range(of_out.shape[2])):
            gates, old, cell = run["gates"][t], run["cells"][t], run["cells"][t + 1]
            i, f, o, g = (gates[..., k * h : (k + 1) * h] for k in range(4))
            bent = np.tanh(cell)
            of_state = of_state + of_out[:, :, t]
            of_cell = of_cell + of_state * o * (1 - bent**2)
            z = of_drive[:, :, t]
            z[..., :h] = of_cell * g * i * (1 - i)
            z[..., h : 2 * h] = of_cell * old * f * (1 - f)
            z[..., 2 * h : 3 * h] = of_state * bent * o * (1 - o)
            z[..., 3 * h :] = of_cell * i * (1 - g**2)
            grad["state"] += run["states"][t].transpose(0, 2, 1) @ z
            of_state = z @ w["state"].transpose(0, 2, 1)
            of_cell = of_cell * f
        grad["bias"] = of_drive.sum((1, 2))[:, None]
        grad["input"] = np.einsum("dnte,dntz->dez", run["inputs"], of_drive, optimize=True)
        grad["embedding"] = np.zeros_like(w["embedding"])
        of_inputs = of_drive @ w["input"].transpose(0, 2, 1)[:, None]
        np.add.at(grad["embedding"], run["both"], of_inputs)

    def decode(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The likeliest tags of each window by Viterbi, and how sure the outputs alone are of each."""
        w, scores = self.weights, self._run(codes)["scores"]
        n, steps = codes.shape
        value, came = w["start"] + scores[:, 0], []
        for t in range(1, steps):
            options = value[:, :, None] + w["step"]
            came.append(options.argmax(1))
            value = options.max(1) + scores[:, t]
        tags = np.empty((n, steps), dtype=np.int64)
        tags[:, -1] = value.argmax(1)
        for t in reversed(range(1, steps)):
            tags[:, t - 1] = came[t - 1][np.arange(n), tags[:, t]]
        sure = np.exp(scores - _logsum(scores, 2)[..., None])
        return tags, sure[np.arange(n)[:, None], np.arange(steps), tags]


def fit(windows: list[str], tags: np.ndarray, settings: Settings = Settings()) -> Network:
    """A network fitted by Adam to the windows and to respelled copies of those with spans."""
    network = Network(settings)
    rng = np.random.default_rng(settings.seed)
    if not windows:
        return network
    more = [_respelled(window, row, rng) for window, row in zip(windows, tags) if row.any()]
    codes = encode([*windows, *[window for window, _ in more]])
    tags = np.concatenate([tags, *[row[None] for _, row in more]])
    first = {name: np.zeros_like(x) for name, x in network.weights.items()}
    second = {name: np.zeros_like(x) for name, x in network.weights.items()}
    step = 0
    for epoch in range(settings.epochs):
        order = rng.permutation(len(codes))
        for low in range(0, len(order), settings.batch):
            own = order[low : low + settings.batch]
            _, grad = network.gradient(codes[own], tags[own])
            size = np.sqrt(sum(float((g**2).sum()) for g in grad.values()))
            step += 1
            rate = settings.rate * min(1, 2 - 2 * epoch / settings.epochs)
            for name, x in network.weights.items():
                g = grad[name] * min(1, 5 / max(size, 1e-9))
                first[name] += 0.1 * (g - first[name])
                second[name] += 0.001 * (g**2 - second[name])
                x -= (
                    rate * (first[name] / (1 - 0.9**step)) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
                ).astype(np.float32)
    return network


def _respelled(window: str, tags: np.ndarray, rng: np.random.Generator) -> tuple[str, np.ndarray]:
    """A window whose spans are written in ways that the rules miss, cut to the same length."""
    text, new, at = [], [], 0
    for kind, start, end in spans_of(tags):
        text.append(window[at:start])
        new.append(tags[at:start])
        own = window[start:end]
        if kind == "email":
            own = own.replace("@", str(rng.choice([" @ ", " (at) ", "[at]", "(at)"])))
        elif kind == "ip":
            own = own.replace(".", str(rng.choice(["[.]", " . ", "(.)"])))
        elif kind == "card":
            between = str(rng.choice([".", "/", " - "]))
            digits = _digits(own)
            own = between.join(digits[i : i + 4] for i in range(0, len(digits), 4))
        else:
            own = re.sub(r"^\+[0-9]+\s*", str(rng.choice(["", "1 ", "001 "])), own)
        first = 1 + 2 * KINDS.index(kind)
        text.append(own)
        new.append(np.array([first] + [first + 1] * (len(own) - 1))[: len(own)])
        at = end
    text.append(window[at:])
    new.append(tags[at : len(window)])
    row = np.zeros(WINDOW, dtype=np.int64)
    joined = np.concatenate(new)[:WINDOW]
    row[: len(joined)] = joined
    return "".join(text)[:WINDOW], row


def spans_of(tags: np.ndarray) -> list[Span]:
    """Runs of one kind in a row of tags; a beginning starts another run."""
    found, open_kind, start = [], None, 0
    for i, value in enumerate([*tags.tolist(), 0]):
        kind = KINDS[(value - 1) // 2] if value else None
        if open_kind is not None and (kind != open_kind or value % 2):
            found.append((open_kind, start, i))
            open_kind = None
        if kind is not None and open_kind is None:
            open_kind, start = kind, i
    return found


def window_starts(text: str) -> list[int]:
    """Starts of the windows, of all that the text is cut into, that have a trigger."""
    last = max(-(-(len(text) - WINDOW) // STRIDE), 0)
    met, done = [], -1
    for match in TRIGGER.finditer(text):
        high = min(match.start() // STRIDE, last)
        low = min(max(-(-(match.start() + 1 - WINDOW) // STRIDE), 0), last)
        met.extend(range(max(low, done + 1), high + 1))
        done = max(done, high)
    return [n * STRIDE for n in met]


def network_spans(network: Network, texts: list[str]) -> list[list[tuple[str, int, int, float]]]:
    """Every text's spans as the network alone sees them, with how sure it is: windows reconciled.

    Spans of one kind that overlap or touch, from whatever windows, are one.
    Of overlapping spans of different kinds the surest stays, then the first.
    """
    places = [(row, start) for row, text in enumerate(texts) for start in window_starts(text)]
    raw: list[list[tuple[str, int, int, float]]] = [[] for _ in texts]
    for low in range(0, len(places), BATCH):
        part = places[low : low + BATCH]
        tags, sure = network.decode(encode([texts[row][start : start + WINDOW] for row, start in part]))
        for i in np.flatnonzero(tags.any(1)):
            row, at = part[i]
            for kind, start, end in spans_of(tags[i]):
                end = min(end, len(texts[row]) - at)
                if start < end:
                    raw[row].append((kind, at + start, at + end, float(sure[i, start:end].mean())))
    return [_reconciled(spans) for spans in raw]


def _reconciled(spans: list[tuple[str, int, int, float]]) -> list[tuple[str, int, int, float]]:
    united: list[list] = []
    for kind in KINDS:
        last = None
        for _, start, end, sure in sorted(s for s in spans if s[0] == kind):
            if last is not None and start <= last[2]:
                last[2], last[3] = max(last[2], end), max(last[3], sure)
            else:
                last = [kind, start, end, sure]
                united.append(last)
    # Those that overlap stand together in order of start, so only neighbours are compared.
    kept: list[list] = []
    for span in sorted(united, key=lambda s: (s[1], KINDS.index(s[0]))):
        while kept and kept[-1][2] > span[1] and kept[-1][3] < span[3]:
            kept.pop()
        if not kept or kept[-1][2] <= span[1]:
            kept.append(span)
    return [tuple(span) for span in kept]


def all_spans(texts: list[str], network: Network) -> list[tuple[list[Span], list[Span]]]:
    """Each text's spans by the rules, and those that the network adds.

    An addition is cut to its own characters, overlaps no rule's span and is
    plausible for its kind.
    """
    found = []
    for text, seen in zip(texts, network_spans(network, texts)):
        rules = rule_spans(text)
        taken: list[list[int]] = []  # what the rules' spans cover, in order
        for _, start, end in rules:
            if taken and start < taken[-1][1]:
                taken[-1][1] = max(taken[-1][1], end)
            else:
                taken.append([start, end])
        added = []
        for kind, start, end, _ in seen:
            own = text[start:end]
            start += len(own) - len(own.lstrip(" .,;:|\n\t"))
            end -= len(own) - len(own.rstrip(" .,;:|\n\t(["))
            before = bisect.bisect_left(taken, end, key=lambda span: span[0])
            free = not before or taken[before - 1][1] <= start
            if start < end and free and plausible(kind, text[start:end]):
                added.append((kind, start, end))
        found.append((rules, added))
    return found


def _sampler(settings: Settings) -> Callable:
    """Of a task's windows the least by hash: so many per kind, and of those without a span."""

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[str, dict[str, tuple[int, list[int]]]] = {kind: {} for kind in (*KINDS, "none")}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                spans = rule_spans(text)
                first = 0
                for low in window_starts(text):
                    while first < len(spans) and spans[first][2] <= low:
                        first += 1
                    near = []
                    for span in spans[first:]:
                        if span[1] >= low + WINDOW:
                            break
                        near.append(span)
                    window = text[low : low + WINDOW]
                    tags = tag(near, low, low + WINDOW)
                    kind = KINDS[(int(tags[tags > 0][0]) - 1) // 2] if tags.any() else "none"
                    digest = hashlib.blake2b(window.encode("utf-8", "surrogatepass"), digest_size=7)
                    group = best[kind]
                    group[window] = (int.from_bytes(digest.digest(), "big"), tags.tolist())
                    if len(group) > 4 * settings.windows:
                        best[kind] = _least(group, settings.windows)
        rows = [
            {"kind": kind, "place": place, "window": window, "tags": tags}
            for kind, group in best.items()
            for window, (place, tags) in _least(group, settings.windows).items()
        ]
        yield pa.RecordBatch.from_pylist(rows, _SAMPLE_SCHEMA)

    return sample


_SAMPLE_SCHEMA = pa.schema(
    [("kind", pa.string()), ("place", pa.int64()), ("window", pa.string()), ("tags", pa.list_(pa.int64()))]
)


def _least(group: dict, size: int) -> dict:
    return dict(sorted(group.items(), key=lambda item: (item[1][0], item[0]))[:size])


def train(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> Network:
    """A network fitted to windows of the documents that the rules have labelled.

    The sample is bounded by ``Settings``: the windows with the least hashes,
    each once however often it occurs, for every kind and for windows that
    have a digit or an ``@`` but no span. It is all that comes to the driver.
    Without such windows the network finds nothing.
    """
    rows = docs.select(F.col(text).alias("text")).filter(F.col("text").rlike(r"(?i)[0-9@]|[(\[]at[)\]]"))
    windows = rows.mapInArrow(
        _sampler(settings), "kind string, place bigint, window string, tags array<bigint>"
    ).dropDuplicates(["kind", "window"])
    picked = top_per_group(windows, ["kind"], [F.asc("place"), F.asc("window")], settings.windows)
    sample = sorted(picked.toArrow().to_pylist(), key=lambda row: (row["kind"], row["place"], row["window"]))
    tags = np.array([row["tags"] for row in sample], dtype=np.int64).reshape(len(sample), WINDOW)
    return fit([row["window"] for row in sample], tags, settings)


def find(docs: DataFrame, network: Network, text: str = "text") -> DataFrame:
    """The documents with ``spans``, an array of ``(kind, start, end, added)`` by start, then kind.

    Starts and ends count code points, ends exclusive; ``added`` tells the
    network's spans from the rules'. Whole texts are searched, of any length;
    a NULL or empty one has no spans. A column called ``spans`` is replaced,
    others are kept. Each document is searched in the task that reads it.
    """
    held = docs.sparkSession.sparkContext.broadcast(network)
    kind = "array<struct<kind:string,start:int,end:int,added:boolean>>"

    @F.arrow_udf(kind)
    def spans(column: pa.Array) -> pa.Array:
        texts = [value or "" for value in column.to_pylist()]
        out = []
        for rules, added in all_spans(texts, held.value):
            extra = set(added)
            out.append(
                [
                    {"kind": k, "start": start, "end": end, "added": (k, start, end) in extra}
                    for k, start, end in _sorted([*rules, *added])
                ]
            )
        return pa.array(out, _SPANS)

    (own,) = unused(docs, "found_spans")
    return docs.withColumn(own, spans(F.col(text))).select(
        *[F.col(name) for name in docs.columns if name != "spans"], F.col(own).alias("spans")
    )


_SPANS = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("added", pa.bool_())])
)


def listed(spans: Column) -> Column:
    """Spans as text: ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
