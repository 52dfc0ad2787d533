"""Packing documents into training sequences by best-fit decreasing."""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsieve.llm.common import bucket_bits, running_total
from docsieve.session import stored

#: Pieces that one task packs.
PIECES_PER_GROUP = 50_000
#: Words and pieces of words whose ids a worker remembers.
CACHE = 600_000
#: Texts that are looked up together.
TEXTS = 1000

#: Fixed values of the tokenizer's own rules: which chunks can be split here, and where its pre-tokenizer splits them.
PLAIN = r"[!-~À-ÖØ-öø-ÿ]+"
PRE_TOKENS = r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+"


class WordTokenizer:
    """Token ids of whole texts by a tokenizer whose words never cross white space.

    Its normaliser and pre-tokenizer act inside runs without white space, so the
    ids of a text are those of its runs one after another, and the ids of runs are
    remembered.  The parts that the pre-tokenizer cuts plain runs into are merged
    by the file's own ranks, with a byte that no text has as the end of a word;
    runs with other characters go to the tokenizer whole, many in one call.  Above
    ``CACHE`` remembered runs the older half is forgotten.
    """

    END = b"\xff"

    def __init__(self, path: str):
        import json
        import os
        import re

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain, self.cut = re.compile(PLAIN), re.compile(PRE_TOKENS)
        self.runs: dict[str, bytes] = {}
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        suffix = content["model"]["end_of_word_suffix"]
        special = {token["content"] for token in content["added_tokens"]}
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(printable)))}
        ranks = {}
        for token, number in content["model"]["vocab"].items():
            if token not in special:
                ends = token.endswith(suffix)
                ranks[bytes(shown[c] for c in token.removesuffix(suffix)) + self.END * ends] = number
        # Ids rise in the order of merging, letters with the end of a word first.
        encoding = tiktoken.Encoding("words", pat_str="[^\n]+", mergeable_ranks=ranks, special_tokens={})
        self.merge = encoding._core_bpe.encode_single_piece

    def _learn(self, runs: list[str]) -> None:
        others = []
        for run in runs:
            if run.isascii() and run.isalpha():
                # Letters alone are one part.
                self.runs[run] = array("I", self.merge(run.lower().encode() + self.END)).tobytes()
            elif self.plain.fullmatch(run) and "<|" not in run:
                ids: list[int] = []
                for part in self.cut.findall(run.lower()):
                    ids += self.merge(part.encode() + self.END)
                self.runs[run] = array("I", ids).tobytes()
            else:
                others.append(run)
        for start in range(0, len(others), 10_000):
            some = others[start : start + 10_000]
            found = self.tokenizer.encode_batch(some, add_special_tokens=False)
            self.runs.update(zip(some, (array("I", e.ids).tobytes() for e in found), strict=True))

    def flat_ids(self, texts: pa.Array) -> tuple:
        """``(ids, starts, ends)``: the ids of all texts one after another, and where those of each lie.

        The runs are told apart in Arrow, only distinct ones are looked up, and their ids are put in place by index.
        """
        import numpy as np

        spaced = pc.replace_substring(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), "\t", " ")
        parts = pc.split_pattern(spaced, " ")
        coded = parts.flatten().dictionary_encode()
        distinct, which = coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False)
        if len(self.runs) > CACHE:
            self.runs = dict(list(self.runs.items())[len(self.runs) // 2 :])
        self._learn([run for run in distinct if run not in self.runs])
        found = list(map(self.runs.__getitem__, distinct))
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts, per_run = np.cumsum(lengths) - lengths, lengths[which]
        ends = np.cumsum(per_run)
        flat = np.frombuffer(b"".join(found), np.uint32)
        ids = flat[np.repeat(starts[which] - ends + per_run, per_run) + np.arange(int(ends[-1]) if len(ends) else 0)]
        edges = np.concatenate(([0], ends))[parts.offsets.to_numpy() - parts.offsets[0].as_py()]
        return ids, edges[:-1].tolist(), edges[1:].tolist()

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as unsigned 32-bit numbers."""
        ids, starts, ends = self.flat_ids(pa.array(texts, pa.string()))
        for start, end in zip(starts, ends, strict=True):
            yield ids[start:end].tobytes()


_tokenizers: dict[str, WordTokenizer] = {}


def word_tokenizer(path: str) -> WordTokenizer:
    """The worker's tokenizer for a file, loaded once."""
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Best-fit decreasing: the sequence and the offset of every piece.

    Pieces are placed by decreasing length into the open sequence with the least
    remaining capacity that holds them, or a new one.  A segment tree over the
    capacities 0 to ``window`` holds how many open sequences have each; the
    smallest fitting capacity is found by walking up from the length and down
    again, in steps of its depth.
    """
    leaves = 1 << max(1, math.ceil(math.log2(window + 1)))
    tree = [0] * (2 * leaves)
    open_at: dict[int, list[int]] = {}
    filled: list[int] = []
    sequence, offset = [0] * len(lengths), [0] * len(lengths)

    def change(capacity: int, by: int) -> None:
        node = capacity + leaves
        while node:
            tree[node] += by
            node >>= 1

    def tightest(length: int) -> int | None:
        node = length + leaves
        if not tree[node]:
            while node > 1 and (node & 1 or not tree[node + 1]):
                node >>= 1
            if node == 1:
                return None
            node += 1
            while node < leaves:
                node = 2 * node if tree[2 * node] else 2 * node + 1
        return node - leaves

    for piece in sorted(range(len(lengths)), key=lambda p: -lengths[p]):
        length = lengths[piece]
        capacity = tightest(length)
        if capacity is None:
            place, capacity = len(filled), window
            filled.append(0)
        else:
            place = open_at[capacity].pop()
            change(capacity, -1)
        sequence[piece], offset[piece] = place, filled[place]
        filled[place] += length
        left = capacity - length
        if left:
            open_at.setdefault(left, []).append(place)
            change(left, 1)
    return sequence, offset


def token_pieces(
    docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", window: int = 4096, end_id: int = 2
) -> DataFrame:
    """``(id, start, length, ids_crc32, doc_tokens)``: every document cut into full windows and one shorter rest."""
    chosen = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    id_type = chosen.select("id").limit(0).toArrow().schema.field("id").type

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        encoder = word_tokenizer(tokenizer_path)
        end = end_id.to_bytes(4, "little")
        for batch in batches:
            rows, starts, lengths, crcs, totals = [], [], [], [], []
            for first in range(0, batch.num_rows, TEXTS):
                flat, begins, ends = encoder.flat_ids(batch.column(1).slice(first, TEXTS))
                for row, (low, high) in enumerate(zip(begins, ends, strict=True), first):
                    ids = flat[low:high].tobytes() + end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        part = ids[4 * start : 4 * (start + window)]
                        rows.append(row)
                        starts.append(start)
                        lengths.append(len(part) // 4)
                        crcs.append(zlib.crc32(part))
                        totals.append(total)
            keys = batch.column(0).take(pa.array(rows, pa.int64()))
            numbers = [pa.array(v, pa.int64()) for v in (starts, lengths, crcs, totals)]
            yield pa.RecordBatch.from_arrays([keys.cast(id_type), *numbers], ["id", "start", "length", "ids_crc32", "doc_tokens"])

    return chosen.mapInArrow(cut, f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


def pack_sequences(
    docs: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = 4096,
    end_id: int = 2,
    per_group: int = PIECES_PER_GROUP,
    seed: int = 42,
) -> DataFrame:
    """Pack the token ids of all documents, each ended by ``end_id``, into sequences of at most ``window`` ids.

    Overlong documents are first cut into full windows, which are sequences of
    their own.  The rests, at most one a document, are dealt by a hash to groups
    of about ``per_group`` and each group is packed by best-fit decreasing in one
    task, so no task's work grows with the table and a group leaves at most a few
    sequences badly filled.  Returns one row per piece: ``(id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset)``.  A null text is empty and its
    only id is ``end_id``; rows that repeat are packed as often; an empty table
    gives no rows; other columns are ignored.
    """
    pieces = stored(token_pieces(docs, tokenizer_path, id_col=id_col, text_col=text_col, window=window, end_id=end_id))
    rests = pieces.where(F.col("length") < window)
    groups = max(1, math.ceil(rests.count() / per_group))
    spot = F.xxhash64(F.lit(seed), "id", "start", "ids_crc32", "doc_tokens")
    names = ["id", "start", "length", "ids_crc32", "doc_tokens"]
    dealt = rests.withColumn("order", spot)
    # Rows that repeat share a hash; their number among all rests deals them to different groups.
    numbered = running_total(dealt, [], "order", ["length"], F.lit(1), "number", bucket_bits(groups * per_group))
    grouped = numbered.withColumn("group", F.col("number") % groups)

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("order", "ascending"), ("number", "ascending")])
        places, offsets = best_fit(table.column("length").to_pylist(), window)
        group = table.column("group")[0].as_py()
        # Even numbers, so that full windows can take the odd ones.
        sequence = [2 * (place * groups + group) for place in places]
        kept = table.select(names)
        return kept.append_column("sequence_id", pa.array(sequence, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id bigint, offset bigint"
    packed = grouped.groupBy("group").applyInArrow(pack, schema)
    whole = pieces.where(F.col("length") == window).select(
        *names,
        (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(whole)
