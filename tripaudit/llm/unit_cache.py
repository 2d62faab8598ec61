"""Token ids of text units, encoded in batches when first met and kept for a while."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Units kept in each of two generations, and the longest that is kept beyond its batch.
KEPT_UNITS = 300_000
KEPT_CHARS = 64
# Letters that every normal form and lower-casing rule treats alike, one code point for one.
LETTERS = re.compile("[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
# Signs of which a run behind a letter or digit is a word of its own to the tokenizers used here.
SIGNS = ".,;:!?#&$%*|"
WORDS_AT_ONCE = 256


def _byte_letters() -> dict[int, int]:
    """Bytes to the letters that stand for them in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return dict(zip(printable, printable)) | {b: 256 + n for n, b in enumerate(others)}


BYTE_LETTERS = _byte_letters()
RUN_LETTERS = BYTE_LETTERS | {10: 32}  # of words with line ends between them
SPACE = chr(BYTE_LETTERS[32])
WORD_END = "</w>"


BYTES_AT_ONCE = 6_000_000


def text_slices(texts: pa.Array, most: int = BYTES_AT_ONCE) -> list[tuple[int, int]]:
    """``(start, number)`` of runs of texts of about ``most`` bytes together; a longer text is a run of its own."""
    run = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64) // most
    starts = np.flatnonzero(np.diff(run, prepend=-1))
    return list(zip(starts.tolist(), np.diff(starts, append=len(texts)).tolist()))


class UnitCache:
    """Ids as little-endian unsigned 32-bit bytes, by unit.

    Units in use move to the young generation; when that is full the old one is
    dropped, so that what occurs often stays and memory is bounded.
    """

    def __init__(self, path: str, led: bool):
        """``led``: the tokenizer marks the beginning of a word (its space), not the end."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = WhitespaceSplit()
        tokens = self.tokenizer.get_vocab(with_added_tokens=False)
        self.led = led
        self.marks = np.zeros(max(tokens.values()) + 1, bool)
        self.marks[[i for t, i in tokens.items() if (t[0] == SPACE if led else t.endswith(WORD_END))]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of units that are one word of letters to the tokenizer (with its space, if that leads it), by its model alone, many words to a call."""
        runs = ["\n".join(words[at : at + WORDS_AT_ONCE]) for at in range(0, len(words), WORDS_AT_ONCE)]
        joined = [run.encode().decode("latin-1").translate(RUN_LETTERS) for run in runs]
        out = []
        for found in self.model.encode_batch_fast(joined, add_special_tokens=False):
            ids = np.array(found.ids, "<u4")
            cuts = 4 * np.flatnonzero(self.marks[ids])
            ends = [*cuts[1:].tolist(), 4 * len(ids)] if self.led else (cuts + 4).tolist()
            data = ids.tobytes()
            out += [data[a:z] for a, z in zip([0, *ends], ends)]
        return out

    def look_up(self, units: list[str]) -> list[bytes]:
        """Ids of different units."""
        if len(self.young) > KEPT_UNITS:
            self.old = {u: i for u, i in self.young.items() if len(u) <= KEPT_CHARS}
            self.young = {}
        young, old = self.young, self.old
        found = list(map(young.get, units))
        if None in found:
            unseen = [u for u, ids in zip(units, found) if ids is None]
            fresh = [u for u in unseen if u not in old] if old else unseen
            if len(fresh) < len(unseen):
                young.update((u, old[u]) for u in unseen if u in old)
            young.update(zip(fresh, self.encode_units(fresh)))
            found = [young[u] if ids is None else ids for u, ids in zip(units, found)]
        return found

    def gather(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all units one after the other, and how many each has; each different unit is looked up once."""
        coded = units.dictionary_encode()
        own = self.look_up(coded.dictionary.to_pylist())
        ids = pa.array(own, pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, 8 * ids.offset) // 4
        return np.frombuffer(ids.buffers()[2] or b"", "<u4", ends[-1] - ends[0], 4 * ends[0]), np.diff(ends)

    def encode_units(self, units: list[str]) -> list[bytes]:
        return self.encode(units)
