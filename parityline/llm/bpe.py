"""Byte-pair encoding and decoding by a pair occurrence index.

A task collects the distinct pieces (words after the vocabulary's own normalising and splitting) that it has not met
yet: stretches of plain Latin letters and ASCII signs are lowered and cut here, all others by the library's own normaliser
and pre-tokenizer, whose Unicode tables are what counts. It lays their symbols out in one list, linked within each piece. An index maps each mergeable pair to all its
positions. Active ranks are taken in ascending order: every position of the rank's pair that still holds is merged
from left to right, and the two pairs that arise beside it enter the lists of their own ranks. If such a rank is
below the rank just taken (a vocabulary may spell one token in two ways), the pieces concerned are encoded anew one
merge at a time, so that the result is the library's in every case.

Decoding looks each id up in the vocabulary and joins the tokens as the file's decoder says: with a space where the
file names none.

Edge cases: a null text counts as empty and gives no ids and an empty text; repeated rows give repeated rows, null ids too; a
text of one very long word takes n log n steps; an empty table gives an empty result; other columns are ignored. A
vocabulary that keeps white space, or whose normaliser or decoder is of another kind, is refused with an error.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityline.llm.common import kept, steps, text_bytes, tokenizer_path
from parityline.llm.tokens import PLAIN, drops_blanks

#: Symbols that the pair index lays out at once, pieces and stretches that a task remembers.
BLOCK_SYMBOLS, REMEMBERED = 4_000_000, 600_000
#: Text bytes that a task takes at once: the more pieces are merged together, the fewer steps over the ranks, but the words
#: of a step are objects of the worker, many times its size, and much of their memory stays with the worker after the task.
TASK_STEP = 1 << 19


def byte_letters() -> list[str]:
    """The printable letter that byte-level vocabularies use for each byte: itself where printable, else from 256 on."""
    out, extra = [], 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(extra))
            extra += 1
    return out


class PairIndexBpe:
    """Encodes and decodes with the vocabulary of a tokenizers .json file of kind BPE."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("continuing_subword_prefix") or model.get("dropout"):
            raise ValueError("not a plain BPE vocabulary")
        if not drops_blanks(path):
            raise ValueError("a vocabulary that keeps white space")
        vocab = model["vocab"]
        letters, suffix = byte_letters(), model.get("end_of_word_suffix") or ""
        self.inner = [vocab[c] for c in letters]
        self.final = [vocab[c + suffix] for c in letters]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.ranks.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.by_rank = {r: (*pair, new) for pair, (r, new) in self.ranks.items()}
        keys = np.asarray([a << 32 | b for a, b in self.ranks], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.asarray([r for r, _ in self.ranks.values()])[order]
        self.inner_ids, self.final_ids = np.asarray(self.inner, np.int32), np.asarray(self.final, np.int32)
        special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *special.values()]) + 1)
        for t, i in [*vocab.items(), *special.items()]:
            self.tokens[i] = t
        self.special = {t.encode(): np.asarray([i], "<u4").tobytes() for t, i in special.items()}
        self.special_starts = {t[:1] for t in self.special}
        self.cut_special = regex.compile(b"(" + b"|".join(regex.escape(t) for t in self.special) + b")") if special else None
        normalizer, split = spec["normalizer"] or {"type": "Sequence", "normalizers": []}, spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = normalizer["normalizers"] if normalizer["type"] == "Sequence" else [normalizer]
        self.lowers = any(x["type"] == "Lowercase" for x in kinds)
        if spec["decoder"] is not None:
            raise ValueError("a decoder that is not handled")
        self.cut = regex.compile(split["pattern"]["Regex"]).findall
        # The library with nothing but this file's normaliser and splitter.
        from tokenizers import Tokenizer

        library = Tokenizer.from_str(json.dumps(spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "pre_tokenizer": split, "added_tokens": [], "post_processor": None}))
        normal = library.normalizer.normalize_str if spec["normalizer"] else str
        self.library = lambda s: [p for p, _ in library.pre_tokenizer.pre_tokenize_str(normal(s))]
        self.pieces: dict[str, bytes] = {}
        self.known: dict[bytes, bytes] = {}

    # -- pieces ---------------------------------------------------------------------------------------------------

    def _pieces(self, stretch: bytes) -> list[str]:
        s = stretch.decode("utf-8", "replace")
        if PLAIN.fullmatch(s) is None:
            return self.library(s)
        if self.lowers:
            s = s.lower()
        if s.isascii():
            if s.isalpha():
                return [s]
            if s[:-1].isalpha():
                return [s[:-1], s[-1]]
        return self.cut(s)

    def _symbols(self, piece: str) -> list[int]:
        data = piece.encode()
        out = [self.inner[b] for b in data]
        out[-1] = self.final[data[-1]]
        return out

    def _one_by_one(self, piece: str) -> list[int]:
        """The defining order: the lowest rank first, the leftmost of it first, one merge at a time."""
        s = [*self._symbols(piece), -1]
        end = len(s) - 1
        following, previous = [*range(1, end + 1), end], [*range(-1, end)]
        heap: list[tuple[int, int]] = []

        def note(i: int) -> None:
            found = self.ranks.get((s[i], s[following[i]])) if i >= 0 else None
            if found:
                heapq.heappush(heap, (found[0], i))

        for i in range(end):
            note(i)
        while heap:
            rank, i = heapq.heappop(heap)
            left, right, new = self.by_rank[rank]
            j = following[i]
            if s[i] != left or s[j] != right:  # merged since
                continue
            s[i], s[j], following[i] = new, -1, following[j]
            previous[following[j]] = i
            note(previous[i])
            note(i)
        return [x for x in s if x >= 0]

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the symbol pairs can merge, and the ranks of those."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        hit = self.pair_keys[at] == key
        return hit, self.pair_ranks[at[hit]]

    def _merge_block(self, block: list[str]) -> None:
        """Encode distinct pieces together by the pair occurrence index."""
        data = [p.encode() for p in block]
        ends = np.cumsum([len(x) for x in data])
        raw = np.frombuffer(b"".join(data), np.uint8)
        n = len(raw)
        symbol = np.append(self.inner_ids[raw], -1)  # the last place stands for "none"
        symbol[ends - 1] = self.final_ids[raw[ends - 1]]
        following, previous = np.arange(1, n + 2), np.arange(-1, n)
        following[ends - 1] = n
        previous[np.append(0, ends[:-1])] = n
        index: defaultdict[int, list[np.ndarray]] = defaultdict(list)
        active: list[int] = []
        odd: list[np.ndarray] = []

        def note(positions: np.ndarray) -> np.ndarray:
            """Enter the pairs that start at these positions into the lists of their ranks."""
            hit, ranks = self._rank_of(symbol[positions], symbol[following[positions]])
            positions = positions[hit]
            if not len(positions):
                return positions
            order = np.argsort(ranks, kind="stable")
            ranks, positions = ranks[order], positions[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            starts = [0, *cuts.tolist()]
            for r, lo, hi in zip(ranks[starts].tolist(), starts, [*starts[1:], len(ranks)], strict=True):
                if r not in index:
                    heapq.heappush(active, r)
                index[r].append(positions[lo:hi])
            return positions[ranks <= rank]

        rank = -1
        note(np.flatnonzero(following[:n] != n))
        while active:
            rank = heapq.heappop(active)
            left, right, new = self.by_rank[rank]
            lists = index.pop(rank)
            i = np.unique(np.concatenate(lists)) if len(lists) > 1 else lists[0]
            j = following[i]
            holds = (symbol[i] == left) & (symbol[j] == right)
            if left == right:  # of overlapping places the left one counts
                last, keep = -1, []
                for x, y, ok in zip(i.tolist(), j.tolist(), holds.tolist(), strict=True):
                    keep.append(ok and x != last)
                    last = y if keep[-1] else last
                holds = np.asarray(keep, bool)
            i, j = i[holds], j[holds]
            if not len(i):
                continue
            symbol[i], symbol[j] = new, -1
            k = following[i] = following[j]
            previous[k] = i
            beside = np.concatenate((i[k != n], previous[i]))
            early = note(np.unique(beside[beside != n]))
            if len(early):
                odd.append(early)
        again = set(np.searchsorted(ends, np.concatenate(odd), "right").tolist()) if odd else ()
        kept = symbol[:n] >= 0
        ids, stops = symbol[:n][kept].astype("<u4").tobytes(), (np.cumsum(kept)[ends - 1] * 4).tolist()
        for m, (piece, lo, hi) in enumerate(zip(block, [0, *stops], stops, strict=False)):
            self.pieces[piece] = np.asarray(self._one_by_one(piece), "<u4").tobytes() if m in again else ids[lo:hi]

    def _learn(self, pieces: Iterable[str]) -> None:
        block, held = [], 0
        for p in pieces:
            block.append(p)
            held += len(p)
            if held > BLOCK_SYMBOLS:
                self._merge_block(block)
                block, held = [], 0
        if block:
            self._merge_block(block)

    def forget(self) -> None:
        """Give back what was remembered; to be called at the end of a task, as the tables outlive it."""
        self.known.clear()
        self.pieces.clear()

    # -- texts ----------------------------------------------------------------------------------------------------

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of each text."""
        if len(self.known) > REMEMBERED or len(self.pieces) > REMEMBERED:
            self.known.clear()
            self.pieces.clear()
        stretches = [t.split() for t in texts]
        seen: set[bytes] = set()
        for s in stretches:
            seen.update(s)
        new = seen.difference(self.known)
        del seen
        cut: dict[bytes, list] = {}
        for x in new:
            if any(c in x for c in self.special_starts) and self.cut_special.search(x):
                parts = [self.special.get(p) or self._pieces(p) for p in self.cut_special.split(x) if p]
                cut[x] = [y for p in parts for y in ([p] if isinstance(p, bytes) else p)]
            else:
                cut[x] = self._pieces(x)
        self._learn({p for c in cut.values() for p in c if isinstance(p, str)}.difference(self.pieces))
        pieces = self.pieces
        for x, c in cut.items():
            self.known[x] = pieces[c[0]] if len(c) == 1 and c[0] in pieces else b"".join([p if isinstance(p, bytes) else pieces[p] for p in c])
        get = self.known.__getitem__
        out = [b"".join(map(get, s)) for s in stretches]
        for x in new:
            if len(x) > 64:
                del self.known[x]
        return out

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode_decode(docs: DataFrame, tokenizer: str, keep_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, with keep_ids, ids (array<int>) and decoded."""
    schema = f"{id_col} {dict(docs.dtypes)[id_col]}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded string" * keep_ids
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = kept(("bpe", tokenizer), lambda: PairIndexBpe(tokenizer))
        for batch in steps(batches, "text", TASK_STEP):
            ids = bpe.encode(batch.column("text").to_pylist())
            texts = [bpe.decode(x) for x in ids]
            columns = [
                batch.column(0),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in texts], pa.string()),
            ]
            if keep_ids:
                columns += [pa.array([np.frombuffer(x, "<i4") for x in ids], pa.list_(pa.int32())), pa.array(texts, pa.string())]
            yield pa.record_batch(columns, names)
        bpe.forget()

    return docs.select(F.col(id_col), text_bytes(text_col).alias("text")).mapInArrow(run, schema)


def op6_bpe(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_decode(docs, tokenizer_path("word_bpe_49k.json"), keep_ids=False)
