"""Library tokenizers inside tasks: whole texts in, token ids out.

A vocabulary whose normaliser and pre-tokenizer drop white space gives each stretch between ASCII white space the
same ids wherever it stands. For such a file (`drops_blanks` reads that from the file itself) the library encodes
each distinct stretch of a task once and a dictionary serves the repeats; every other file gets whole texts.

Most of the library's time goes into normalising and splitting. Stretches of ASCII and Latin letters need none of
its Unicode tables: they are lowered and cut here, and the library's model encodes each distinct piece, many at a
time. All other stretches, and those that may hold a special string, go through the whole library.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Callable, Iterable

import numpy as np
import regex

from parityline.llm.common import quiet_threads

#: Distinct stretches that a task remembers, and the longest that it remembers. When full, it starts anew.
REMEMBERED, REMEMBERED_BYTES = 600_000, 64
#: Letters, digits and signs whose lower case and NFC form are settled: printable ASCII, Latin-1 and Latin Extended-A
#: letters without the one whose lower case is two characters.
PLAIN = re.compile("[\x21-\x7e\u00c0-\u012f\u0132-\u017f]+")


def file_digest(path: str) -> str:
    """Names a tokenizer version: SHA-256 of its file."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def drops_blanks(path: str) -> bool:
    """Whether ids of a text are the ids of its stretches between ASCII white space, one after the other."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)

    def parts(x: dict | None, key: str) -> list[dict]:
        return [] if x is None else x[key] if x["type"] == "Sequence" else [x]

    for n in parts(spec.get("normalizer"), "normalizers"):
        if n["type"] == "Replace":
            if n["pattern"] != {"Regex": "\\s+"} or n["content"] != " ":
                return False
        elif n["type"] not in ("NFC", "Lowercase"):
            return False
    first = (parts(spec.get("pre_tokenizer"), "pretokenizers") or [{"type": ""}])[0]
    if first["type"] != "Split" or first["behavior"] != "Removed" or not first["invert"]:
        return False
    found = regex.compile(first["pattern"].get("Regex", ".")).findall("a b\tc\n1 2\r!\x0b?\x0c'")
    return not any(regex.search(r"\s", x) for x in found) and not any(
        x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] or regex.search(r"\s", x["content"])
        for x in spec.get("added_tokens", [])
    )


class Encoder:
    """Texts (UTF-8 bytes) to ids (little-endian unsigned 32-bit), as the library gives them without special tokens."""

    def __init__(self, path: str) -> None:
        quiet_threads()
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.split, self.ends = drops_blanks(path), None
        self.lookup: Callable[[list[str]], Iterable[list[int]]]
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.lookup = lambda texts: model.encode(texts, num_threads=1)
            return
        from tokenizers import Tokenizer

        def library() -> Tokenizer:
            t = Tokenizer.from_file(path)
            t.no_truncation()
            t.no_padding()
            return t

        def lookup(t: Tokenizer) -> Callable[[list[str]], Iterable[list[int]]]:
            return lambda texts: [x.ids for x in t.encode_batch_fast(texts, add_special_tokens=False)]

        self.lookup = lookup(library())
        if self.split:
            with open(path, encoding="utf-8") as f:
                spec = json.load(f)
            suffix, steps = spec["model"].get("end_of_word_suffix"), spec["pre_tokenizer"].get("pretokenizers", [])
            if suffix and [x["type"] for x in steps] == ["Split", "ByteLevel"] and not steps[1]["use_regex"]:
                from tokenizers import normalizers, pre_tokenizers

                model_only = library()
                model_only.normalizer = normalizers.Sequence([])
                whole = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
                model_only.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), whole])
                self.model, self.cut = lookup(model_only), regex.compile(steps[0]["pattern"]["Regex"]).findall
                self.first = {x["content"][0] for x in spec.get("added_tokens", [])}
                vocab = model_only.get_vocab(with_added_tokens=True)
                self.ends = np.zeros(max(vocab.values()) + 1, bool)
                self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True

    def _whole(self, texts: list[bytes]) -> list[bytes]:
        ids = self.lookup([t.decode("utf-8", "replace") for t in texts])
        return [np.asarray(x, "<u4").tobytes() for x in ids]

    def _learn(self, pieces: list[str]) -> None:
        """Encode pieces by the model, 256 at a time; each ends with the one token that carries the suffix."""
        for i in range(0, len(pieces), 65536):
            part = pieces[i : i + 65536]
            joined = self.model([" ".join(part[k : k + 256]) for k in range(0, len(part), 256)])
            ids = np.fromiter(itertools.chain.from_iterable(joined), "<u4")
            stops = (np.flatnonzero(self.ends[ids]) + 1) * 4
            if len(stops) != len(part):
                for piece, x in zip(part, self.model(part), strict=True):
                    self.pieces[piece] = np.asarray(x, "<u4").tobytes()
                continue
            data, stops = ids.tobytes(), stops.tolist()
            self.pieces.update(zip(part, [data[a:b] for a, b in zip([0, *stops], stops)], strict=True))

    def _new(self, stretches: list[bytes]) -> dict[bytes, bytes]:
        """Ids of distinct stretches."""
        if self.ends is None:
            return dict(zip(stretches, self._whole(stretches), strict=True))
        if len(self.pieces) > REMEMBERED:
            self.pieces.clear()
        rest, cut, odd = [], [], self.first
        for x in stretches:
            s = x.decode("utf-8", "replace")
            if len(s) > REMEMBERED_BYTES or PLAIN.fullmatch(s) is None or not odd.isdisjoint(s):
                rest.append(x)
                cut.append(None)
                continue
            s = s.lower()
            if s.isalpha():
                cut.append((s,))
            elif s[:-1].isalpha():
                cut.append((s[:-1], s[-1]))
            else:
                cut.append(self.cut(s))
        self._learn(list({p for x in cut if x for p in x}.difference(self.pieces)))
        get = self.pieces.__getitem__
        out = {x: get(p[0]) if len(p) == 1 else b"".join(map(get, p)) for x, p in zip(stretches, cut, strict=True) if p is not None}
        for i in range(0, len(rest), 4096):
            part = rest[i : i + 4096]
            out.update(zip(part, self._whole(part), strict=True))
        return out

    def forget(self) -> None:
        """Give back what was remembered; to be called at the end of a task, as the encoder itself outlives it."""
        self.known.clear()
        self.pieces.clear()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.split:
            return self._whole(texts)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        stretches = [t.split() for t in texts]  # bytes.split() cuts at exactly the six ASCII blanks
        seen: set[bytes] = set()
        for s in stretches:
            seen.update(s)
        new = list(seen.difference(self.known))
        del seen
        self.known.update(self._new(new))
        get = self.known.__getitem__
        out = [b"".join(map(get, s)) for s in stretches]
        for x in new:
            if len(x) > REMEMBERED_BYTES:
                del self.known[x]
        return out
