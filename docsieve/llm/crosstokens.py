"""Token alignment of two tokenizers over the same texts, by anchors before space-marked tokens."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsieve.session import stored

#: Bits of a token id, and of the times that one entry counts a link.
ID_BITS, TIMES_BITS = 20, 22
#: Characters of text that are aligned at a time, and share the memory of their windows.
SLICE = 1 << 20
#: Links with at least this share of all are few enough, by their number, to send to every task.
FREQUENT = 100_000

_loaded: dict[tuple, tuple] = {}


def byte_level(path: str, pattern: str) -> tuple:
    """The encoder and the token bytes by id of a byte-level BPE in JSON form; special tokens are left out."""
    key = ("byte", path, pattern)
    if key not in _loaded:
        import json

        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(plain)))}
        special = {token["content"] for token in content["added_tokens"]}
        ranks = {bytes(shown[c] for c in token): i for token, i in content["model"]["vocab"].items() if token not in special}
        encoding = tiktoken.Encoding("aligned", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        table = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            table[i] = token

        def encode(texts: list[str]) -> list:
            return [encoding.encode_to_numpy(" " + text) for text in texts]

        _loaded[key] = (encode, table)
    return _loaded[key]


def pieces(path: str) -> tuple:
    """The encoder, which adds the leading space itself, and the token bytes by id of a sentence-piece model."""
    key = ("pieces", path)
    if key not in _loaded:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        table = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            table.append(bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())

        def encode(texts: list[str]) -> list:
            return model.encode(texts, num_threads=1)

        _loaded[key] = (encode, table)
    return _loaded[key]


def _hashes(ids, cuts):
    """A 64-bit hash of each stretch of ids between neighbouring cuts."""
    import numpy as np

    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    place = np.arange(len(ids)) - np.repeat(cuts[:-1], np.diff(cuts))
    powers = np.full(int(place.max()) + 1, 0xC2B2AE3D27D4EB4F, np.uint64).cumprod()
    return np.add.reduceat(mixed * powers[place], cuts[:-1])


class Aligner:
    """Aligns texts, each distinct window of ids among them once."""

    def __init__(self, first: tuple, second: tuple) -> None:
        import numpy as np

        self.encoders = [first[0], second[0]]
        self.tables = [first[1], second[1]]
        self.lengths = [np.array([len(t) for t in table], np.int64) for table in self.tables]
        self.bytes = [np.frombuffer(b"".join(table), np.uint8) for table in self.tables]
        self.starts = [np.cumsum(x) - x for x in self.lengths]
        self.spaced = [np.array([t[:1] == b" " for t in table]) for table in self.tables]
        # An id with what follows it: more of its side, or the other side or group.
        shown = [b"%d%c" % (i, mark) for table, marks in zip(self.tables, (b",|", b",;"), strict=True) for mark in marks for i in range(len(table))]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_length = np.array([len(x) for x in shown], np.int64)
        self.shown_start = np.cumsum(self.shown_length) - self.shown_length

    def windows(self, ids: list, counts: list) -> tuple[list[bytes], object, object]:
        """``(groups, links, ends)``: the groups of each of many windows as text, and their links as packed id pairs.

        ``ids`` are the two sides' ids, window after window, and ``counts`` how many of them each window has.  There is a
        link for every overlap; those of a window stop at its end in ``ends``.
        """
        import numpy as np

        ends = [np.cumsum(lengths[x]) for lengths, x in zip(self.lengths, ids, strict=True)]
        marks = [np.zeros(ends[0][-1] + 1, bool) for _ in ends]
        for mark, at in zip(marks, ends, strict=True):
            mark[at] = True
        # Between two neighbouring ends of either side lies one token of each.
        cuts = np.nonzero(marks[0] | marks[1])[0]
        over = [np.searchsorted(e, cuts) for e in ends]
        links = ids[0][over[0]].astype(np.int64) << ID_BITS | ids[1][over[1]]
        shared = [marks[1 - side][ends[side]] for side in (0, 1)]
        starts = [np.concatenate(([0], np.nonzero(x)[0] + 1)) for x in shared]
        groups = [np.cumsum(x) - x for x in shared]
        codes = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        base = 2 * len(self.tables[0])
        codes[np.arange(len(ids[0])) + starts[1][groups[0]]] = ids[0] + shared[0] * len(self.tables[0])
        codes[np.arange(len(ids[1])) + starts[0][groups[1] + 1]] = ids[1] + base + shared[1] * len(self.tables[1])
        size = self.shown_length[codes]
        after = np.cumsum(size)
        text = self.shown[np.repeat(self.shown_start[codes] - after + size, size) + np.arange(size.sum())].tobytes()
        stops = after[np.cumsum(counts[0]) + np.cumsum(counts[1]) - 1].tolist()
        texts = [text[low : stop - 1] for low, stop in zip([0, *stops], stops, strict=False)]
        return texts, links, np.searchsorted(cuts, ends[0][np.cumsum(counts[0]) - 1]) + 1

    def remembered(self, ids: list, stops: list) -> tuple[list[bytes], object, object, list[int]]:
        """``windows`` of the distinct ones, and which of them each window is; ``stops`` end the windows on the two sides.

        Windows are the same when their ids are: a hash brings candidates together, and ids that differ from those of
        the first with a hash make a window of its own.
        """
        import numpy as np

        cuts = [np.concatenate(([0], x)) for x in stops]
        per_window = [np.diff(x) for x in cuts]
        # The ids of both sides of a window, A's first; those of B are told apart by a high bit.
        both = np.empty(len(ids[0]) + len(ids[1]), np.uint32)
        both[np.arange(len(ids[0])) + np.repeat(cuts[1][:-1], per_window[0])] = ids[0]
        both[np.arange(len(ids[1])) + np.repeat(cuts[0][1:], per_window[1])] = ids[1] | np.uint32(1 << ID_BITS)
        at = cuts[0] + cuts[1]
        length = np.diff(at)
        _, first, which = np.unique(_hashes(both, at), return_index=True, return_inverse=True)
        model = first[which]
        model = np.where(length[model] == length, model, np.arange(len(length)))
        same = both[np.repeat(at[model] - at[:-1], length) + np.arange(len(both))] == both
        model = np.where(np.logical_and.reduceat(same, at[:-1]), model, np.arange(len(length)))
        chosen, which = np.unique(model, return_inverse=True)
        parts, counts = [], []
        for x, cut, count in zip(ids, cuts, per_window, strict=True):
            count = count[chosen]
            ahead = np.cumsum(count) - count
            parts.append(x[np.repeat(cut[chosen] - ahead, count) + np.arange(count.sum())])
            counts.append(count)
        return *self.windows(parts, counts), which

    def spelled(self, ids: list, counts: list, wholes: list[bytes]) -> list[bool]:
        """Whether the token bytes of each text are its bytes on both sides."""
        import numpy as np

        good = np.ones(len(wholes), bool)
        expected = np.frombuffer(b"".join(wholes), np.uint8)
        stops = np.cumsum([len(x) for x in wholes])
        for x, count, lengths, starts, flat in zip(ids, counts, self.lengths, self.starts, self.bytes, strict=True):
            size = lengths[x]
            per_text = np.add.reduceat(np.append(size, 0), np.minimum(np.cumsum(count) - count, len(size))) * (count > 0)
            good &= per_text == np.diff(stops, prepend=0)
            if not good.all():
                # Only texts of the right length can be compared byte by byte.
                size, x = (np.where(np.repeat(good, count), y, z) for y, z in ((size, 0), (x, 0)))
            ahead = np.cumsum(size) - size
            found = flat[np.repeat(starts[x] - ahead, size) + np.arange(size.sum())]
            wanted = expected if good.all() else expected[np.repeat(good, np.diff(stops, prepend=0))]
            if not np.array_equal(found, wanted):
                owner = np.repeat(np.arange(len(wholes)), np.diff(stops, prepend=0) * good)
                good[owner[found != wanted]] = False
        return good.tolist()

    def align(self, texts: list[str]) -> list[tuple]:
        """``(n_a, n_b, n_groups, n_links, groups, links)`` of every text; None without tokens."""
        import numpy as np

        out: list = [None] * len(texts)
        rows = [row for row, text in enumerate(texts) if text]
        if not rows:
            return out
        ids = [[np.asarray(x, np.uint32) for x in encode([texts[row] for row in rows])] for encode in self.encoders]
        sizes = [np.array([len(x) for x in side]) for side in ids]
        good = self.spelled([np.concatenate(side) for side in ids], sizes, [b" " + texts[row].encode() for row in rows])
        rows = [row for row, fits in zip(rows, good, strict=True) if fits]
        if not rows:
            return out
        ids = [[x for x, fits in zip(side, good, strict=True) if fits] for side in ids]
        counts = [np.array([len(x) for x in side]) for side in ids]
        flat = [np.concatenate(side) for side in ids]
        ends = [np.cumsum(lengths[x]) for lengths, x in zip(self.lengths, flat, strict=True)]
        marked = [np.zeros(ends[0][-1] + 1, bool) for _ in ends]
        for mark, at in zip(marked, ends, strict=True):
            mark[at] = True
        shared = [np.nonzero(marked[1 - side][ends[side]])[0] for side in (0, 1)]
        # An anchor is a shared end before which both sides go on with a space-marked token, or the end of a text.
        anchor = np.ones(len(shared[0]), bool)
        for side in (0, 1):
            following = np.append(self.spaced[side][flat[side]], True)[1:]
            anchor &= following[shared[side]]
        last = np.cumsum(counts[0]) - 1
        of_text = np.searchsorted(shared[0], last)
        anchor[of_text] = True
        n_groups = np.diff(np.concatenate(([0], of_text + 1)))
        stops = [shared[side][anchor] + 1 for side in (0, 1)]
        bounds = [0, *(np.searchsorted(stops[0], last + 1) + 1).tolist()]
        texts_of, links_of, link_ends, which = self.remembered(flat, stops)
        per_window = np.diff(link_ends, prepend=0)[which]
        begins = (link_ends - np.diff(link_ends, prepend=0))[which]
        ahead = np.cumsum(per_window) - per_window
        links = links_of[np.repeat(begins - ahead, per_window) + np.arange(per_window.sum())]
        per_text = np.add.reduceat(per_window, bounds[:-1])
        # The links of all texts in one sort, by text and pair.
        owner = np.repeat(np.arange(len(rows)), per_text)
        order = np.sort(owner << 2 * ID_BITS | links)
        first = np.nonzero(np.concatenate(([True], order[1:] != order[:-1])))[0]
        times = np.diff(np.append(first, len(order)))
        pairs, most = order[first], (1 << TIMES_BITS) - 1
        while (times > most).any():
            # An entry counts so many at most; what is over makes another.
            over = np.nonzero(times > most)[0]
            pairs, more = np.insert(pairs, over, pairs[over]), times[over] - most
            times[over] = most
            times = np.insert(times, over, more)
        packed = (pairs & ((1 << 2 * ID_BITS) - 1)) << TIMES_BITS | times
        entries = np.searchsorted(pairs >> 2 * ID_BITS, np.arange(len(rows) + 1)).tolist()
        show, which = texts_of.__getitem__, which.tolist()
        for place, row in enumerate(rows):
            groups = b";".join(map(show, which[bounds[place] : bounds[place + 1]]))
            numbers = (int(counts[0][place]), int(counts[1][place]), int(n_groups[place]), int(per_text[place]))
            out[row] = (*numbers, groups, packed[entries[place] : entries[place + 1]])
        return out


#: One for each worker.
_aligners: dict[tuple, Aligner] = {}


def aligned_tokens(
    docs: DataFrame, byte_level_path: str, pattern: str, pieces_path: str, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(row, id, n_a, n_b, n_groups, n_links, groups, links)``: both tokenizations of every document, aligned.

    Each text is encoded whole, A by a byte-level BPE of space and text, B by a sentence-piece model that adds the
    space.  Byte offsets where tokens of both end cut the document into groups; ``groups`` lists their ids, ``a1,a2|b1;
    a3|b2``.  A token of A and one of B are linked where their bytes overlap; ``links`` holds each linked pair of ids
    with its times in the document, packed.  Shared ends before space-marked tokens of both cut the document into
    windows first, and each distinct window of ids is aligned once for the texts at hand, ``SLICE`` characters or so.  Texts that are null or empty, or whose token
    bytes joined differ from space and text on either side, have no tokens: zeros, no groups and no links.  Rows that
    repeat are returned as often, an empty table gives no rows, other columns are ignored; very long texts are
    encoded whole.  ``row`` numbers the rows; it holds for one evaluation, so store the result to use it.
    """
    chosen = docs.select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    names = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "groups", "links"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        key = (byte_level_path, pattern, pieces_path)
        if key not in _aligners:
            _aligners[key] = Aligner(byte_level(byte_level_path, pattern), pieces(pieces_path))
        aligner = _aligners[key]
        for batch in batches:
            sizes = np.cumsum(np.fromiter((len(x.as_py() or "") for x in batch.column(2)), np.int64, batch.num_rows))
            starts = [0, *(np.nonzero(np.diff(sizes // SLICE))[0] + 1).tolist(), batch.num_rows]
            for begin, end in zip(starts, starts[1:], strict=False):
                part = batch.slice(begin, end - begin)
                nothing = (0, 0, 0, 0, b"", np.zeros(0, np.int64))
                found = [x or nothing for x in aligner.align([x.as_py() or "" for x in part.column(2)])]
                if not found:
                    continue
                *numbers, groups, links = zip(*found, strict=True)
                columns = [pa.array(x, pa.int64()) for x in numbers]
                columns += [pa.array(groups, pa.binary()).cast(pa.string()), pa.array(links, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names)

    schema = f"row bigint, id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, links array<bigint>"
    return chosen.mapInArrow(run, schema)


def link_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, c, best)``: how many links hold each pair of ids, and whether none of its B id's pairs is in more."""
    entry = aligned.select(F.explode("links").alias("entry"))
    counted = entry.groupBy(F.shiftright("entry", TIMES_BITS).alias("pair")).agg(
        F.sum(F.col("entry").bitwiseAND(F.lit((1 << TIMES_BITS) - 1))).alias("c")
    )
    # A window holds the pairs of one B id, at most as many as A has tokens.
    of_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1)))
    return counted.select("pair", "c", (F.col("c") == F.max("c").over(of_b)).alias("best"))


def scored_links(aligned: DataFrame) -> DataFrame:
    """Stored ``aligned_tokens`` with ``n_best``, the links whose count is the highest of their B id, and ``count_sum``.

    The pairs with at least one in ``FREQUENT`` of all links, so at most that many, go to every task and meet the links
    there; the few links that are left meet the other pairs by shuffle.
    """
    counts = stored(link_counts(aligned))
    total = counts.agg(F.sum("c")).first()[0] or 0
    often = F.col("c") >= total / FREQUENT
    frequent = F.broadcast(counts.where(often))
    entry = aligned.select("row", F.explode("links").alias("entry"))
    entry = entry.select(
        "row", F.shiftright("entry", TIMES_BITS).alias("pair"), F.col("entry").bitwiseAND(F.lit((1 << TIMES_BITS) - 1)).alias("times")
    )
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("c")).alias("count_sum")]
    common = entry.join(frequent, "pair").groupBy("row").agg(*sums)
    rest = entry.join(frequent, "pair", "left_anti").join(counts.where(~often), "pair").groupBy("row").agg(*sums)
    scores = common.unionByName(rest).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    joined = aligned.drop("links").join(scores, "row", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_best", "count_sum")}).drop("row")
