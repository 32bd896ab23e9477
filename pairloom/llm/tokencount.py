"""Token counts of a byte-pair model by rank-synchronous merging of ragged numpy arrays.

All new pre-tokens of a batch lie in one flat array. In every round each of them joins
its pair of the lowest rank, all at the same time; what is left at the end is counted. A
pre-token is a run of blanks and the characters after it: no piece of the vocabulary holds a blank
after another character, so no merge crosses its ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from pairloom.llm.blocks import column_bytes, slices, sums
from pairloom.llm.piececache import PieceCache
from pairloom.llm.vocab import blank_led
from pairloom.llm.ship import cleared, prepare, tidy

NEVER = np.iinfo(np.int32).max
BLANK = 0x2581
_SPACE = np.zeros(256, bool)
_SPACE[0x20] = True

_counters: dict[str, tuple["MergeCounter", PieceCache]] = cleared({})


class MergeCounter:
    """The merges of a sentencepiece byte-pair model with byte fallback and no text normalisation."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        train, norm = model.trainer_spec, model.normalizer_spec
        if train.model_type != train.BPE or not train.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("not a byte-pair model with byte fallback and identity normalisation")
        self.prefix = norm.add_dummy_prefix
        scores = {p.piece: p.score for p in model.pieces if p.type == p.NORMAL}
        if any(chr(BLANK) in p.lstrip(chr(BLANK)) for p in scores):
            raise ValueError("a piece has a blank after another character")
        chars = sorted({c for p in scores for c in p})
        names = chars + sorted(p for p in scores if len(p) > 1)
        number = {p: i for i, p in enumerate(names)}
        levels = {s: i for i, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.chars = np.array([ord(c) for c in chars], np.uint32)
        self.in_vocab = np.array([c in scores for c in chars])
        pairs = {}
        for piece, score in scores.items():
            for cut in range(1, len(piece)):
                a, b = number.get(piece[:cut]), number.get(piece[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = (levels[score], number[piece])
        self.keys = np.array(sorted(pairs), np.int64)
        ranked = [pairs[k] for k in self.keys.tolist()]
        self.rank = np.array([r for r, _ in ranked] + [NEVER], np.int32)
        self.made = np.array([m for _, m in ranked] + [0], np.int64)
        # A rank may join all its places at once unless some merge with its result comes earlier than
        # itself, or several pieces share the rank.
        own = {m: r for r, m in pairs.values()}
        one_by_one = np.zeros(len(levels) + 1, bool)
        seen: dict[int, int] = {}
        for m, r in own.items():
            if seen.setdefault(r, m) != m:
                one_by_one[r] = True
        for key, (r, _) in pairs.items():
            for part in (key >> 32, key & 0xFFFFFFFF):
                if part in own and r <= own[part]:
                    one_by_one[own[part]] = True
        self.one_by_one = one_by_one

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index of each pair among the merges; the last index is none."""
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.keys[at] == key), at, len(self.keys))

    def count(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each pre-token."""
        texts = b"".join(pieces).decode("utf-8")
        points = np.frombuffer(texts.encode("utf-32-le"), np.uint32)
        points = np.where(points == 0x20, BLANK, points).astype(np.uint32)
        size = np.array([len(p.decode("utf-8")) for p in pieces], np.int64)
        at = np.minimum(np.searchsorted(self.chars, points), len(self.chars) - 1)
        known = self.chars[at] == points
        symbol = np.where(known, at, -1).astype(np.int64)
        # A character outside the vocabulary becomes its UTF-8 bytes.
        width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000).astype(np.int64)
        weight = np.where(known & self.in_vocab[at], 1, width)
        out = np.zeros(len(pieces), np.int64)
        live = np.flatnonzero(size)
        size = size[live]
        open_ = np.ones(len(symbol), bool)  # has a right neighbour in its own sequence
        open_[np.cumsum(size) - 1] = False
        pair = np.full(len(symbol), len(self.keys))
        i = np.flatnonzero(open_)
        pair[i] = self._pairs(symbol[i], symbol[i + 1])
        while len(live):
            first = np.cumsum(size) - size
            rank = self.rank[pair]
            least = np.minimum.reduceat(rank, first)
            done = least == NEVER
            if done.any():
                out[live[done]] = sums(weight, size)[done]
                keep = np.repeat(~done, size)
                symbol, weight, pair, open_, rank = symbol[keep], weight[keep], pair[keep], open_[keep], rank[keep]
                live, size, least = live[~done], size[~done], least[~done]
                if not len(live):
                    break
                first = np.cumsum(size) - size
            chosen = np.flatnonzero(rank == np.repeat(least, size))
            # Places that overlap are taken from the left, every other one of a run.
            new_run = np.ones(len(chosen), bool)
            new_run[1:] = (chosen[1:] != chosen[:-1] + 1) | ~open_[chosen[:-1]]
            run_start = np.flatnonzero(new_run)
            in_run = np.arange(len(chosen)) - np.repeat(run_start, np.diff(np.append(run_start, len(chosen))))
            take = in_run % 2 == 0
            owner = np.searchsorted(first, chosen, "right") - 1
            lone = self.one_by_one[least[owner]]
            if lone.any():
                leading = np.ones(len(chosen), bool)
                leading[1:] = owner[1:] != owner[:-1]
                take &= ~lone | leading
            chosen, owner = chosen[take], owner[take]
            symbol[chosen] = self.made[pair[chosen]]
            weight[chosen] = 1
            open_[chosen] = open_[chosen + 1]
            keep = np.ones(len(symbol), bool)
            keep[chosen + 1] = False
            symbol, weight, pair, open_ = symbol[keep], weight[keep], pair[keep], open_[keep]
            size = size - np.bincount(owner, minlength=len(size))
            now = chosen - np.arange(len(chosen))
            left = now - 1
            changed = np.unique(np.concatenate([now, left[left >= 0]]))
            pair[changed] = len(self.keys)
            changed = changed[open_[changed]]
            pair[changed] = self._pairs(symbol[changed], symbol[changed + 1])
        return out


def _encode(counter: MergeCounter):
    def encode(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return counter.count(pieces).astype(np.uint32), np.arange(len(pieces)), np.ones(len(pieces), np.int64)

    return encode


def text_counts(path: str, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Tokens of whole texts, one after another in ``data``."""
    if path not in _counters:
        counter = MergeCounter(path)
        _counters[path] = (counter, PieceCache(_encode(counter)))
    counter, cache = _counters[path]
    body = data.tobytes()
    blank = chr(BLANK).encode()
    if blank in body:  # the model's own sign for a blank is a blank
        texts = [body[a:b].replace(blank, b" ") for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    if counter.prefix:
        filled = np.diff(offsets) > 0
        data = np.insert(data, offsets[:-1][filled], 0x20)
        offsets = offsets + np.concatenate([[0], np.cumsum(filled)])
    starts, ends, counts = blank_led(data, offsets, _SPACE, np.zeros(len(offsets) - 1, bool))
    begin, _ = cache.find(data, starts, ends)
    return sums(cache.pool[begin].astype(np.int64), counts)


def count_tokens(docs: DataFrame, model: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every whole text, without begin or end tokens.

    Null and empty texts have 0 bytes and 0 tokens; equal and null ids stay rows of their own; an
    empty table gives no row; other columns are ignored. One pass without a shuffle.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("n_bytes", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
    ])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = column_bytes(batch.column(1))
            for low, high in slices(offsets):
                begin = offsets[low]
                tokens = text_counts(model, data[begin:offsets[high]], offsets[low:high + 1] - begin)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), pa.array(np.diff(offsets[low:high + 1])), pa.array(tokens),
                ], names=["id", "n_bytes", "n_tokens"])

    made = rows.mapInArrow(tidy(count), schema)
    return made.select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
