"""Statistics of whole texts, counted in one narrow pass; the quality operators share them.

Words are runs of bytes other than 0x20 and 0x09-0x0D. A null text counts as empty, and every count of an empty text is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reciprospark.llm.common import record, slices

COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_chars_all", "n_lines", "n_distinct", "n_upper", "n_lower", "n_digits", "n_punct", "n_marked", "n_short_lines", "n_runs",
)
_SYMBOLS, _UPPER, _LOWER, _DIGITS, _PUNCT = b"#*$%&|<>", bytes(range(65, 91)), bytes(range(97, 123)), b"0123456789", b".,;:!?"
_LATER = bytes(range(0x80, 0xC0))  # all bytes of a character but its first


def _without(text: bytes, drop: bytes) -> int:
    return len(text) - len(text.translate(None, drop))


def counted(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Every count of COUNTS for each text."""
    out = {c: np.zeros(len(texts), dtype=np.int64) for c in COUNTS}
    parts, base = [], 0
    for k, text in enumerate(texts):
        if not text:
            continue
        words = text.split()
        seen: dict[bytes, int] = {}
        put = seen.setdefault
        ids = np.fromiter((put(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
        parts.append(ids + base)
        base += len(seen)
        space = _without(text, b" \t\n\r\x0b\x0c")
        later = _without(text, _LATER)
        out["n_words"][k] = len(words)
        out["word_chars"][k] = len(text) - space - later
        out["n_chars_all"][k] = len(text) - later
        out["n_symbols"][k] = _without(text, _SYMBOLS)
        out["n_distinct"][k] = len(seen)
        out["n_upper"][k] = _without(text, _UPPER)
        out["n_lower"][k] = _without(text, _LOWER)
        out["n_digits"][k] = _without(text, _DIGITS)
        out["n_punct"][k] = _without(text, _PUNCT)
        out["n_runs"][k] = int((ids[1:] == ids[:-1]).sum())
        marked = set(b"#*$%&|!<>")
        out["n_marked"][k] = sum(n for n, w in zip(np.bincount(ids, minlength=len(seen)).tolist(), seen, strict=True) if w[-1] in marked)
        lines = [x for x in text.split(b"\n") if x and not x.isspace()]
        out["n_lines"][k] = len(lines)
        out["n_dup_lines"][k] = len(lines) - len(set(lines))
        out["n_short_lines"][k] = sum(len(x) < 30 for x in lines)
    if parts:
        out["n_repeat_words"] = _repeats(parts, texts, out["n_words"], base)
    return out


def _repeats(parts: list[np.ndarray], texts: list[bytes], counts: np.ndarray, base: int) -> np.ndarray:
    """Words inside 3-word windows that a text has twice or more. Ids of different texts differ, so a window belongs to one text."""
    flat = np.concatenate(parts)
    doc = np.repeat(np.arange(len(texts)), counts)
    if len(flat) < 3:
        return np.zeros(len(texts), dtype=np.int64)
    _, pair = np.unique(flat[:-2] * base + flat[1:-1], return_inverse=True)
    _, of, n = np.unique(pair * base + flat[2:], return_inverse=True, return_counts=True)
    again = (n[of] > 1) & (doc[2:] == doc[:-2])
    hit = np.zeros(len(flat), dtype=bool)
    for k in range(3):
        hit[k : k + len(again)] |= again
    return np.bincount(doc[hit], minlength=len(texts))


def with_counts(docs: DataFrame, names: tuple[str, ...] = COUNTS, drop_text: bool = False) -> DataFrame:
    """docs with the named counts of column text, as long; columns of docs with such names are replaced."""
    keep = [c for c in docs.columns if c not in names]
    own = [c for c in keep if not (drop_text and c == "text")]
    kept = docs.select(*keep)
    fields = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name in own] + [f"{c} long" for c in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            found = counted(texts)
            schema = pa.schema([*[batch.schema.field(c) for c in own], *[pa.field(c, pa.int64()) for c in names]])
            yield record(schema, [*[batch.column(c) for c in own], *[found[c] for c in names]])

    return kept.mapInArrow(run, fields)
