"""Main body of a page: a linear-chain conditional random field over its blocks, decoded by Viterbi.

A block is a non-blank line of body_text. Where a line carries markup, its leading tags are its ancestors and become
features; the texts at hand are plain, so the other features are of the text (words, ends, shape, separators), of the
place on the page and of the neighbouring blocks. States: site furniture, page heads (headlines, bylines, captions),
teasers of other pages, and the body; only the body comes out.

Pages are independent rows, so nothing is shuffled. Python workers read Arrow batches of (key, text), score the blocks
of a batch against a fixed weight table and run Viterbi over all pages of the batch at once.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STATES = ["furniture", "head", "teaser", "body"]
BODY = STATES.index("body")
MODEL = Path(__file__).with_name("boilerplate_model.json")
#: Features of one line are kept for short lines only, so that the memory of a worker is bounded.
CACHED_CHARS, CACHED_LINES = 120, 50_000

_DIGITS = re.compile(r"\d+")
_TAGS = re.compile(r"^((?:\s*<[a-zA-Z][^>]*>)+)")
_ENDS = (".", "!", "?", "。", "！", "？", "…")
_QUOTES = "\"'”’»“)）」』"
_BULLETS = ("-", "*", "•", "–", "·", ">", "»", "+")


def _bucket(n: int) -> int:
    return n if n < 4 else 4 + min(4, n.bit_length() - 2)


def _masked(word: str) -> str:
    return "Cc" if word[:1].isupper() else _DIGITS.sub("9", word)


def line_features(line: str) -> tuple[list[str], tuple]:
    """Names of the features of a line alone, and what its neighbours see of it: (ends a sentence, words, shape)."""
    found: list[str] = []
    if line[:1] == "<" and (tags := _TAGS.match(line)):
        found += [f"tag={t.lower()}" for t in re.findall(r"<([a-zA-Z][a-zA-Z0-9]*)", tags[1])]
        line = re.sub(r"<[^>]*>", " ", line).strip()
    words = line.split()
    bare = line.rstrip(_QUOTES)
    ends = bare.endswith(_ENDS)
    n = len(words)
    capitals = sum(1 for w in words if w[:1].isupper())
    bullet = line.startswith(_BULLETS)
    seps = line.count("|") + line.count("›") + line.count("·") + line.count(" / ") + line.count("   ")
    shape = "b" if bullet else "9" if line[:1].isdigit() else "C" if line[:1].isupper() else "q" if line[:1] in "\"“„«'" else "a"
    found += [
        f"n={_bucket(n)}", f"len={_bucket(len(line) // 8)}", f"end={bare[-1:] if not bare[-1:].isalnum() else 'w'}", f"sent={ends}", f"shape={shape}",
        f"caps={capitals * 5 // max(1, n)}", f"caps,end={capitals * 5 // max(1, n)},{ends}", f"n,end={_bucket(n)},{ends}", f"seps={min(seps, 4)}", f"shape,end,n={shape},{ends},{min(n, 9)}",
    ]
    if n:
        first, last = _DIGITS.sub("9", words[0]), _DIGITS.sub("9", words[-1])
        found += [f"w0={first}", f"w-1={last}"]
        if n > 1:
            found += [f"w01={first} {_DIGITS.sub('9', words[1])}", f"w0m1={first} {_masked(words[1])}", f"w-21={_masked(words[-2])} {last}"]
        if n > 2:
            found += [f"w012={first} {words[1]} {words[2]}", f"m012={_masked(first)} {_masked(words[1])} {_masked(words[2])}"]
        if n < 6:
            found.append("m=" + " ".join(map(_masked, words)))
    found.append("line=" + _DIGITS.sub("9", line))
    # All words of the block, however long it is.
    found += ["w=" + w for w in {w.strip(".,;:!?\"'()“”«»").lower() for w in words if w[:1].islower()}]
    # Words right after a capitalised one tell headlines (Name joins Firm) from prose.
    found += ["v=" + b for b in {b for a, b in zip(words, words[1:]) if a[:1].isupper() and b[:1].islower()}]
    return found, (ends, min(n, 12) // 3, shape)


def page_context(seen: list[tuple], i: int, repeated: bool, is_headline: bool) -> list[str]:
    """Names of the features of block ``i`` that depend on the page."""
    n = len(seen)
    before = seen[i - 1] if i else ("^", "^", "^")
    after = seen[i + 1] if i + 1 < n else ("$", "$", "$")
    mine = seen[i]
    return [
        f"top={min(i, 6)}", f"bottom={min(n - 1 - i, 6)}", f"place={i * 8 // n}",
        f"pe={before[0]},{mine[0]}", f"ae={after[0]},{mine[0]}", f"pn={before[1]},{mine[1]}", f"an={after[1]},{mine[1]}", f"ps={before[2]},{mine[2]}", f"as={after[2]},{mine[2]}",
        f"pa={before[0]},{after[0]},{mine[0]},{mine[1]}", f"rep={repeated}", f"head={is_headline}",
    ]


class Blocks:
    """Turns pages into flat arrays of feature ids; unknown features are dropped."""

    def __init__(self, index: dict[str, int]):
        self.index, self._lines, self._contexts = index, {}, {}

    def _line(self, line: str) -> tuple[list[int], tuple]:
        if (known := self._lines.get(line)) is not None:
            return known
        names, seen = line_features(line)
        get = self.index.get
        entry = [j for name in names if (j := get(name)) is not None], seen
        if len(line) <= CACHED_CHARS and len(self._lines) < CACHED_LINES:
            self._lines[line] = entry
        return entry

    def page(self, text: str, headline: str | None) -> tuple[list[int], list[list[int]]]:
        """(line numbers, feature ids) of the non-blank lines."""
        numbers, lines = [], []
        for number, line in enumerate(text.split("\n")):
            if line := line.strip():
                numbers.append(number)
                lines.append(line)
        entries = [self._line(line) for line in lines]
        seen = [e[1] for e in entries]
        counts: dict[str, int] = {}
        for line in lines:
            counts[line] = counts.get(line, 0) + 1
        title = (headline or "").strip().lower()
        return numbers, [e[0] + self._context(seen, i, counts[lines[i]] > 1, bool(title) and lines[i].lower() == title) for i, e in enumerate(entries)]

    def _context(self, seen: list[tuple], i: int, repeated: bool, is_headline: bool) -> list[int]:
        n = len(seen)
        key = (min(i, 6), min(n - 1 - i, 6), i * 8 // n, seen[i], seen[i - 1] if i else None, seen[i + 1] if i + 1 < n else None, repeated, is_headline)
        if (known := self._contexts.get(key)) is None:
            known = [j for name in page_context(seen, i, repeated, is_headline) if (j := self.index.get(name)) is not None]
            if len(self._contexts) < CACHED_LINES:
                self._contexts[key] = known
        return known


def emissions(pages: list[list[list[int]]], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pages x blocks x states) scores, padded, and the number of blocks of each page."""
    sizes = np.array([len(p) for p in pages])
    flat = [ids for page in pages for ids in page]
    counts = np.array([len(ids) for ids in flat], dtype=np.int64)
    scores = np.zeros((len(flat), weights.shape[1]))
    if counts.sum():
        rows = np.concatenate([np.asarray(ids, dtype=np.int64) for ids in flat if ids])
        full = counts > 0
        starts = np.concatenate([[0], np.cumsum(counts[full])[:-1]])
        scores[full] = np.add.reduceat(weights[rows], starts, axis=0)
    out = np.zeros((len(pages), int(sizes.max(initial=0)), weights.shape[1]))
    mask = np.arange(out.shape[1])[None, :] < sizes[:, None]
    out[mask] = scores
    return out, sizes


def viterbi(scores: np.ndarray, sizes: np.ndarray, start: np.ndarray, step: np.ndarray) -> list[np.ndarray]:
    """The best state sequence of each page; blocks beyond a page's size are left out."""
    pages, length, states = scores.shape
    if not length:
        return [np.empty(0, dtype=np.int64)] * pages
    best = scores[:, 0] + start
    back = np.zeros((pages, length, states), dtype=np.int64)
    final = best.copy()
    for i in range(1, length):
        ways = best[:, :, None] + step[None]
        back[:, i] = ways.argmax(1)
        best = ways.max(1) + scores[:, i]
        live = sizes > i
        final[live] = best[live]
    paths = np.zeros((pages, length), dtype=np.int64)
    state = final.argmax(1)
    for i in range(length - 1, -1, -1):
        live = sizes > i
        paths[live, i] = state[live]
        if i:
            moved = back[np.arange(pages), i, state]
            state = np.where(live, moved, state)
    return [paths[p, : sizes[p]] for p in range(pages)]


class Model:
    """Feature index, weights, and the scores of starting in and stepping between states."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, start: np.ndarray, step: np.ndarray):
        self.index, self.weights, self.start, self.step = index, weights, start, step

    @classmethod
    def load(cls, path: Path = MODEL) -> Model:
        raw = json.loads(Path(path).read_text())
        names = list(raw["features"])
        return cls({n: i for i, n in enumerate(names)}, np.array([raw["features"][n] for n in names]), np.array(raw["start"]), np.array(raw["step"]))

    def save(self, path: Path = MODEL) -> None:
        rows = {n: [round(float(x), 3) for x in self.weights[i]] for n, i in self.index.items()}
        body = {"states": STATES, "start": self.start.round(3).tolist(), "step": self.step.round(3).tolist(), "features": rows}
        Path(path).write_text(json.dumps(body, ensure_ascii=False, separators=(",", ":")))

    def decode(self, texts: list[str], headlines: list[str | None], blocks: Blocks | None = None) -> list[tuple[list[int], np.ndarray]]:
        """(line numbers, states) of each page."""
        blocks = blocks or Blocks(self.index)
        pages = [blocks.page(t, h) for t, h in zip(texts, headlines)]
        scores, sizes = emissions([p[1] for p in pages], self.weights)
        return [(page[0], path) for page, path in zip(pages, viterbi(scores, sizes, self.start, self.step))]


def body_lines(pages: DataFrame, key: str = "item_id", text: str = "body_text", headline: str = "headline", model: Model | None = None) -> DataFrame:
    """(key, line_no) of the lines of each page's own body; lines are split at newlines and counted from 0.

    Pages without a text, or of blank lines only, have none. Repeated keys are decoded each; one line of any length is
    one block. A row with a null key keeps its null.
    """
    model = model or Model.load()
    kind = dict(pages.dtypes)[key]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = Blocks(model.index)
        for batch in batches:
            keys, texts, titles = (batch.column(i).to_pylist() for i in range(3))
            for at in range(0, len(keys), 512):
                out_keys, out_lines = [], []
                found = model.decode(texts[at : at + 512], titles[at : at + 512], blocks)
                for k, (numbers, path) in zip(keys[at : at + 512], found):
                    kept = [n for n, state in zip(numbers, path.tolist()) if state == BODY]
                    out_lines += kept
                    out_keys += [k] * len(kept)
                yield pa.RecordBatch.from_arrays([pa.array(out_keys, batch.schema.field(0).type), pa.array(out_lines, pa.int32())], [key, "line_no"])

    rows = pages.filter(F.col(text).isNotNull()).select(key, text, headline)
    return rows.mapInArrow(decode, f"{key} {kind}, line_no int")
