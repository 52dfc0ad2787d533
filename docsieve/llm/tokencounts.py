"""Token counts of sections from one encoding of the whole document."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How a token that crosses a boundary is counted: to the section of its first byte, of its last byte, or with most of its bytes.
RULES = ("first", "last", "most")

_encoders: dict[tuple[str, str], tuple] = {}


def byte_encoder(ranks_path: str, pattern: str) -> tuple:
    """The worker's byte-level encoder and the bytes of each of its tokens, loaded once."""
    key = (ranks_path, pattern)
    if key not in _encoders:
        import base64

        import numpy as np
        import tiktoken

        with open(ranks_path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            lengths[rank] = len(token)
        encoding = tiktoken.Encoding("documents", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        _encoders[key] = (encoding, lengths)
    return _encoders[key]


def attribute(starts, token_ends, section_ends, rule: str):
    """The section of every token: an interval join of two sorted lists of spans.

    Both lists cover the same bytes from 0 without gaps, so ends name the spans.
    """
    import numpy as np

    of_first = np.searchsorted(section_ends, starts, side="right")
    of_last = np.searchsorted(section_ends, token_ends - 1, side="right")
    if rule == "first":
        return of_first
    if rule == "last":
        return of_last
    chosen = of_first.copy()
    for token in np.nonzero(of_first != of_last)[0]:
        # The bytes of the token in each section it touches; the earliest section wins a tie.
        touched = np.arange(of_first[token], of_last[token] + 1)
        ends = np.minimum(section_ends[touched], token_ends[token])
        begins = np.maximum(np.concatenate(([0], section_ends))[touched], starts[token])
        chosen[token] = touched[np.argmax(ends - begins)]
    return chosen


def section_tokens(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    rule: str = "first",
) -> DataFrame:
    """Tokens of every line of every document: ``(id, section, start, end, tokens, crossing)``.

    A section is a line with its line feed.  The whole document is encoded once,
    so merges across line ends count as the model will see them, and token byte
    spans are joined to section spans.  A token over a boundary counts once, by
    ``rule``, so a document's counts add up to its tokens.  ``start`` and ``end``
    are code points, ``crossing`` the tokens counted here that reach into another
    section.  Null and empty texts are one empty section; rows that repeat are
    returned as often; an empty table gives no rows; other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    chosen = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    names = ["section", "start", "end", "tokens", "crossing"]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        encoding, lengths = byte_encoder(ranks_path, pattern)
        for batch in batches:
            rows, parts = [], [[] for _ in names]
            for row, value in enumerate(batch.column(1)):
                text = value.as_py() or ""
                lines = text.split("\n")
                chars = np.cumsum([len(line) + 1 for line in lines])
                chars[-1] -= 1
                if text.isascii():
                    ends = chars
                else:
                    ends = np.cumsum([len(line.encode()) + 1 for line in lines])
                    ends[-1] -= 1
                if len(lines) > 1 and not lines[-1]:
                    ends, chars = ends[:-1], chars[:-1]
                ids = encoding.encode_to_numpy(text) if text else np.zeros(0, np.int64)
                token_ends = np.cumsum(lengths[ids], dtype=np.int64)
                begins = token_ends - lengths[ids]
                sections = attribute(begins, token_ends, ends, rule)
                section_starts = np.concatenate(([0], ends[:-1]))
                crossing = (begins < section_starts[sections]) | (token_ends > ends[sections])
                rows.append(np.full(len(ends), row))
                values = (
                    np.arange(len(ends)),
                    np.concatenate(([0], chars[:-1])),
                    chars,
                    np.bincount(sections, minlength=len(ends)),
                    np.bincount(sections[crossing], minlength=len(ends)),
                )
                for part, found in zip(parts, values, strict=True):
                    part.append(found)
            if rows:
                keys = batch.column(0).take(pa.array(np.concatenate(rows), pa.int64()))
                yield pa.RecordBatch.from_arrays([keys, *[pa.array(np.concatenate(p), pa.int64()) for p in parts]], ["id", *names])

    return chosen.mapInArrow(count, f"id {kind}, " + ", ".join(f"{name} bigint" for name in names))
