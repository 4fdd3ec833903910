"""Token ids by public tokenizers, each distinct part of a text segmented once per worker.

Both vocabularies never join characters across white space, so the ids of a text are the ids of
its parts in order. Parts are remembered up to a bound; full tables are emptied, but for the words at hand.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import accumulate, chain

import numpy as np
import public_tokenizers

SUFFIX = ".,;:!?*$%&#|()\"-+=<>@"
LONG = 64  # longer parts are not remembered
LAST_SIMPLE = "\u1c7f"  # up to here, Unicode versions agree on what a letter is
BLANKS = re.compile("[ \t\n\r\x0b\x0c]+")


def path(name: str) -> str:
    return public_tokenizers.path(name)


class WordIds:
    """Ids of the word-end BPE, as little-endian unsigned 32-bit bytes per word.

    White space ends a word. Within a word, letters and punctuation are separate units, so a word
    made of letters and closing marks is the ids of its letters and those of its marks. Letter units
    not met before are segmented together and told apart by their tokens' offsets. Any other word is
    segmented as it stands.
    """

    WORDS = 500_000
    UNITS = 600_000

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        names = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(names.values()) + 1, bool)
        self.ends[[i for name, i in names.items() if name.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {}
        self.units: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    @staticmethod
    def simple(core: str) -> bool:
        return core.isalpha() and len(core) <= LONG and (core.isascii() or max(core) <= LAST_SIMPLE)

    @staticmethod
    def split(text: str) -> list[str]:
        """Words between white space; the four separators that only Python counts as such stay in words."""
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return [w for w in BLANKS.split(text) if w]
        return text.split()

    def by_offsets(self, units: list[str]) -> list[bytes]:
        """Ids of letter units, told apart by where their tokens start."""
        found = self.tokenizer.encode("\n".join(units), add_special_tokens=False)
        starts = np.cumsum([0, *(len(u) + 1 for u in units)])
        owner = np.searchsorted(starts, np.fromiter((o[0] for o in found.offsets), np.int64, len(found.ids)), "right")
        return self.parted(found.ids, np.bincount(owner, minlength=len(units) + 1)[1:len(units) + 1])

    def by_word_ends(self, units: list[str]) -> list[bytes]:
        """Ids of ASCII letter units: each is one word to the tokenizer, and only a word's last token is marked as its end.
        So no offsets are needed, which cost a third of the segmenting."""
        ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(units)], add_special_tokens=False)[0].ids, "<u4")
        return self.parted(ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1))

    @staticmethod
    def parted(ids, counts: np.ndarray) -> list[bytes]:
        data, at = np.array(ids, "<u4").tobytes(), (4 * np.cumsum([0, *counts])).tolist()
        return [data[i:j] for i, j in zip(at, at[1:])]

    def learn(self, words: list[str], now: set[str]) -> None:
        """Add ids of ``words``. A full table keeps the words of the texts at hand (``now``): the frequent ones stay."""
        if len(self.words) + len(words) > self.WORDS:
            self.words = {w: self.words[w] for w in now if w in self.words}
        cores = [w.rstrip(SUFFIX) for w in words]
        lower = [c.lower() if c.isascii() else c for c in cores]
        fresh = list(filter(self.simple, set(lower).difference(self.units)))
        if fresh:
            if len(self.units) + len(fresh) > self.UNITS:
                self.units.clear()
                fresh = list(filter(self.simple, set(lower)))
            for units, segmented in ((list(filter(str.isascii, fresh)), self.by_word_ends),
                                     ([u for u in fresh if not u.isascii()], self.by_offsets)):
                if units:
                    self.units.update(zip(units, segmented(units)))
        tails, known, found = self.tails, self.words, list(map(self.units.get, lower))
        known.update(zip(words, found))
        for word, core, ids in zip(words, cores, found):
            if ids is None:
                known[word] = self.whole(word)
            elif len(core) != len(word):
                tail = word[len(core):]
                if tail not in tails:
                    if len(tails) > 10_000 or len(tail) > LONG:
                        tails.clear()
                    tails[tail] = self.whole(tail)
                known[word] = ids + tails[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.split(t) for t in texts]
        now = set().union(*split)
        fresh = now.difference(self.words)
        if fresh:
            self.learn(list(fresh), now)
        known = self.words
        return [b"".join([known[w] for w in words]) for words in split]


class ChunkIds:
    """Ids of the sentencepiece model, as little-endian 32-bit bytes per marked word.

    Blanks become markers, and no piece of the model has a marker after another character (checked
    on loading), so a run of markers with the word after it is a unit. Each distinct unit is segmented
    once; its key leaves out the first marker, which the library's prefix supplies.
    """

    BOUND = 500_000
    MARK = "▁"

    def __init__(self, file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        crossing = [p for p in pieces if re.search(f"[^{self.MARK}]{self.MARK}", p)]
        if crossing:
            raise ValueError(f"pieces cross white space: {crossing[:3]}")
        self.is_byte = np.array([self.model.is_byte(i) for i in range(len(pieces))])
        self.newline = self.model.piece_to_id("<0x0A>")
        self.alone = np.array([self.model.piece_to_id(self.MARK)], "<i4").tobytes()
        self.units: dict[str, bytes] = {"": self.alone}
        self.run = re.compile(f"{self.MARK}+[^{self.MARK}]*")

    def parts(self, text: str) -> list[str]:
        if not text:
            return []
        marked = text.replace(" ", self.MARK)
        found = marked.split(self.MARK)
        if "" in found:  # runs of markers, or one at an end
            return [m[1:] for m in self.run.findall(self.MARK + marked)]
        return found

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.parts(t) for t in texts]
        fresh = set().union(*split).difference(self.units)
        if fresh:
            if len(self.units) + len(fresh) > self.BOUND:
                self.units = {"": self.alone}
                fresh = set().union(*split) - {""}
            fresh = list(fresh)
            ids = self.model.encode(fresh, num_threads=1)
            data = np.fromiter(chain.from_iterable(ids), "<i4").tobytes()
            at = list(accumulate(map(len, ids), initial=0))
            self.units.update(zip(fresh, [data[4 * i:4 * j] for i, j in zip(at, at[1:])]))
        known = self.units
        return [b"".join([known[p] for p in parts]) for parts in split]


@lru_cache(maxsize=4)
def word_ids(file: str) -> WordIds:
    return WordIds(file)


@lru_cache(maxsize=4)
def chunk_ids(file: str) -> ChunkIds:
    return ChunkIds(file)
