"""Token ids of whole texts by a public tokenizer, remembered piece by piece.

The byte-level vocabulary cuts a text into pieces (a word, number or run of marks, with the space
before it; the ends of contractions; blanks) and encodes each apart, so the ids of the pieces,
joined, are those of the whole text. The pieces of a group of texts are found by numpy on
their bytes and made one each by Arrow. Each worker keeps the ids of pieces it has met (at
most about ``REMEMBERED``), has the library encode the new ones of a group in one call, and joins by numpy.

Cuts are made only where they are sure: from one space to the next, a stretch with anything but
ASCII and Latin letters is a piece of its own. Texts in which a space is followed by another blank
or ends the text, and those with an added token, are encoded by the library as they are.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "byte_bpe_50k.json"
#: Pieces and their ids lie in Arrow and numpy arrays, about 30 bytes each.
REMEMBERED = 600_000
#: Bytes of a piece; longer ones are not remembered.
LONGEST = 100
ID_BYTES = 4
#: The vocabulary's own cutting, which :func:`piece_starts` follows.
RULE = "ByteLevel(add_prefix_space=False, trim_offsets=True, use_regex=True)"

#: What a byte is; END stands between texts.
LETTER, DIGIT, MARK, BLANK, SPACE, END, OTHER = range(7)


def _kinds() -> np.ndarray:
    out = np.full(256, OTHER, dtype=np.uint8)
    out[0x21:0x7F] = MARK
    out[0x30:0x3A] = DIGIT
    out[0x41:0x5B] = out[0x61:0x7B] = LETTER
    out[0x09:0x0E] = BLANK
    out[0x20], out[0] = SPACE, END
    return out


KINDS = _kinds()


def byte_kinds(data: np.ndarray) -> np.ndarray:
    """The kind of each byte of UTF-8; both bytes of the Latin letters U+00C0 to U+024F are letters."""
    kinds = KINDS[data]
    high = np.flatnonzero(data >= 0xC3)
    lead, after = data[high], data[high + 1]
    latin = (lead == 0xC3) & (after != 0x97) & (after != 0xB7) | (lead >= 0xC4) & (lead <= 0xC8) | (lead == 0xC9) & (after < 0x90)
    kinds[high[latin]] = kinds[high[latin] + 1] = LETTER
    return kinds


def piece_starts(data: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Where pieces start in texts with an END after each. Right where each space has a piece after it."""
    start = np.empty(len(data), dtype=bool)
    start[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=start[1:])
    space = kinds == SPACE
    start[1:] &= ~space[:-1]
    start |= space
    start |= kinds == END
    # of many blanks before a word the last is a piece of its own
    blank = np.flatnonzero(kinds[1:-1] == BLANK) + 1
    start[blank[(kinds[blank - 1] == BLANK) & (kinds[blank + 1] != BLANK) & (kinds[blank + 1] != SPACE) & (kinds[blank + 1] != END)]] = True
    # contractions, where a piece starts at the apostrophe
    quote = np.flatnonzero(data == 0x27)
    quote = quote[start[quote] & (kinds[quote] == MARK)]
    second, third = data[quote + 1], data[np.minimum(quote + 2, len(data) - 1)]
    one = np.isin(second, list(b"stmd"))
    two = np.isin(second, list(b"rv")) & (third == ord("e")) | (second == ord("l")) & (third == ord("l"))
    start[quote[one | two] + 1] = False
    start[quote[one] + 2] = True
    start[quote[two] + 3] = True
    return np.flatnonzero(start)


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the installed vocabulary file lies, on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


def runs(values: np.ndarray, firsts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that begin at ``firsts``, one after the other."""
    upto = np.cumsum(sizes)
    kind = np.int32 if len(values) + len(sizes) + (upto[-1] if len(upto) else 0) < 1 << 31 else np.int64
    at = np.repeat((firsts - upto + sizes).astype(kind), sizes)
    at += np.arange(len(at), dtype=kind)
    return values[at]


class Encoder:
    """Texts to ids, as little-endian unsigned 32-bit numbers in bytes."""

    #: A space before a blank or the end of a text.
    uneven = r"\x20(?:[\s\x00\x1c-\x1f]|\xc2[\x85\xa0]|\xe1(?:\x9a\x80|\xa0\x8e)|\xe2\x80[\x80-\x8f\xa8-\xaf]|\xe2\x81[\x9f-\xaf]|\xe3\x80\x80)"

    def __init__(self, path: str, remembered: int = REMEMBERED):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if str(self.tokenizer.pre_tokenizer) != RULE or self.tokenizer.normalizer is not None:
            raise ValueError("the vocabulary is not cut by the byte-level rule")
        self.remembered = remembered
        self.known = pa.array([], pa.large_string())
        self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, "<u4")
        vocab = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocab.values()) + 1, dtype=bool)
        for token, i in vocab.items():
            self.opens[i] = token.startswith("Ġ")
        added = [re.escape(t.content.encode()) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = re.compile(b"|".join([self.uneven.encode(), *added])).finditer
        gc.freeze()

    def whole(self, texts: list[str]) -> list[bytes]:
        """Each text by the library alone."""
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
        """The order in which new pieces are remembered, they in it, the number of ids of each, and these
        ids. Those with a space before are encoded as one text, as each begins at an id that opens
        with the space, the others one by one."""
        opened = pc.starts_with(pieces, " ")
        spaced, others = pieces.filter(opened), pieces.filter(pc.invert(opened))
        raw = np.frombuffer(self.whole(["".join(spaced.to_pylist())])[0], "<u4")
        at = np.flatnonzero(self.opens[raw])
        if len(at) != len(spaced):
            raise ValueError("the vocabulary does not open a piece at every space")
        single = self.whole(others.to_pylist())
        sizes = [np.diff(at, append=len(raw)), np.array([len(x) // ID_BYTES for x in single], dtype=np.int64)]
        order = np.argsort(pc.invert(opened).to_numpy(zero_copy_only=False), kind="stable")
        return order, pa.concat_arrays([spaced, others]), np.concatenate(sizes), np.concatenate([raw, np.frombuffer(b"".join(single), "<u4")])

    def recall(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of each of some distinct pieces, and these ids one after the other."""
        at = pc.index_in(pieces, value_set=self.known).fill_null(-1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(at < 0)
        new = pieces.take(pa.array(missing))
        if len(new):
            order, new, sizes, ids = self.learn(new)
            at[missing[order]] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, new])
            self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])
        sizes = self.sizes[at]
        ids = runs(self.ids, (np.cumsum(self.sizes) - self.sizes)[at], sizes)
        if len(self.known) > self.remembered:  # those of this group are known, or none if these are too many
            keep = pc.less_equal(pc.binary_length(pieces), LONGEST if len(pieces) <= self.remembered else -1)
            kept = keep.to_numpy(zero_copy_only=False)
            self.known, self.sizes, self.ids = pieces.filter(keep), sizes[kept], ids[np.repeat(kept, sizes)]
        elif len(new) and pc.max(pc.binary_length(new)).as_py() > LONGEST:
            keep = pc.less_equal(pc.binary_length(self.known), LONGEST)
            kept = keep.to_numpy(zero_copy_only=False)
            self.known, self.sizes, self.ids = self.known.filter(keep), self.sizes[kept], self.ids[np.repeat(kept, self.sizes)]
        return sizes, ids

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        if not texts:
            return []
        raw = "\x00".join([*texts, ""]).encode()
        data = np.frombuffer(raw, dtype=np.uint8)
        ends = np.flatnonzero(data == 0)
        if len(ends) != len(texts):  # the character itself is in a text
            nul = ["\x00" in t for t in texts]
            some, rest = iter(self.whole([t for t, n in zip(texts, nul) if n])), iter(self.encode([t for t, n in zip(texts, nul) if not n]))
            return [next(some if n else rest) for n in nul]
        kinds = byte_kinds(data)
        starts = piece_starts(data, kinds)
        # from a space to the next nothing is cut if something there is not plain
        opens = np.isin(kinds[starts], (SPACE, END))
        opens[0] = True
        opens[1:] |= kinds[starts[:-1]] == END
        stretch = np.cumsum(opens) - 1
        plain = np.ones(stretch[-1] + 1, dtype=bool)
        plain[np.searchsorted(starts[opens], np.flatnonzero(kinds == OTHER), side="right") - 1] = False
        starts = starts[opens | plain[stretch]]
        del kinds, opens, stretch

        bounds = np.append(starts, len(data))
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(raw)).dictionary_encode()
        del bounds
        of = pieces.indices.to_numpy()
        # texts encoded as they are
        odd = np.unique(np.searchsorted(ends, [m.start() for m in self.odd(raw)])) if len(raw) else []
        text = np.searchsorted(starts, ends)  # the piece of each END
        if len(odd):
            skip = np.zeros(len(starts) + 1, dtype=np.int32)
            skip[np.where(odd > 0, text[odd - 1] + 1, 0)] += 1
            skip[text[odd]] -= 1
            skip = np.cumsum(skip[:-1]) > 0
            asked = np.zeros(len(pieces.dictionary), dtype=bool)
            asked[of[~skip]] = True
        else:
            skip, asked = None, np.ones(len(pieces.dictionary), dtype=bool)
        asked[of[text[0]]] = False  # END has no ids
        sizes = np.zeros(len(asked), dtype=np.int64)
        sizes[asked], ids = self.recall(pieces.dictionary.filter(pa.array(asked)))
        n = sizes[of]
        if skip is not None:
            n[skip] = 0
        upto = np.cumsum(n)
        found = runs(ids, (np.cumsum(sizes) - sizes)[of], n).tobytes()
        cuts = [0, *(upto[text] * ID_BYTES).tolist()]
        out = [found[a:b] for a, b in zip(cuts, cuts[1:])]
        for i, whole in zip(odd, self.whole([texts[i] for i in odd])):
            out[i] = whole
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One per worker and vocabulary; workers serve many tasks."""
    return Encoder(path)
