"""Token ids of texts with a public tokenizer, a word at a time.

The tokenizer's pre-tokenizer never lets a token reach over the start of a run of white space
that follows other characters. A text is cut there, the distinct words of a batch of texts
are encoded by the tokenizers library together, and ids of whole texts are joined from them. The ids are those of a plain call
without special tokens added; the literal of a special token in a text gets that token's id, as there.
"""

from __future__ import annotations

import re
from array import array
from codecs import charmap_decode
from itertools import islice
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The file of the vocabulary; a parameter of every operator that counts or writes tokens.
DEFAULT_VOCABULARY = "byte_bpe_50k.json"
#: Pieces of texts with unusual white space that a worker keeps; beyond, the later half is forgotten.
CACHED_PIECES = 120_000
#: White space other than a single blank or line feed between words.
_UNUSUAL = re.compile(r"[^\S \n]")
_PIECE = re.compile(r"\s*\S+|\s+\Z")
#: Byte-level vocabularies write a byte as itself if it is printable, else as the next character from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
ALPHABET = {b: chr(b) for b in _PRINTABLE} | {
    b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in _PRINTABLE)
}
BLANK, FEED = ALPHABET[32], ALPHABET[10]
_BYTES = {c: b for b, c in ALPHABET.items()}
_AS_WRITTEN = "".join(ALPHABET[b] for b in range(256))
#: Signs that are a piece by themselves behind letters; an apostrophe may be the start of an ending.
MARKS = punctuation.replace("'", "")
#: So few words go to the model one by one; of more, so many make a string, and so many strings a call.
_FEW, _TOGETHER, _STRINGS = 16, 32, 256
#: Tokens of byte-level vocabularies that need a closer look: with a blank inside, a line feed, or a mark behind something.
_SUSPECT = re.compile(f".{BLANK}|{FEED}|[^{re.escape(MARKS)}][{re.escape(MARKS)}]")


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize
        self.size = self.tokenizer.get_vocab_size()
        #: Ids of pieces of texts with unusual white space.
        self.pieces: dict[str, bytes] = {}
        pre = self.tokenizer.pre_tokenizer
        added = self.tokenizer.get_added_tokens_decoder().values()
        #: Added tokens that reach over white space: a text that holds one is encoded whole.
        self.across = [t.content for t in added if t.rstrip or any(c.isspace() for c in t.content)]
        self.byte_level = (
            type(pre).__name__ == "ByteLevel" and self.tokenizer.normalizer is None
            # No added token is hidden in letters with marks.
            and not any((t.content.strip("\n ").rstrip(MARKS) or "a").isalpha() for t in added)
        )
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        #: The model without the pre-tokenizer, for many words at once if they stay apart there.
        self.bare = Tokenizer(self.tokenizer.model)
        self.together = self.byte_level and not any(map(_over_words, filter(_SUSPECT.search, vocabulary)))
        #: Whether a token starts a word, by id.
        self.starts = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.starts[[k for t, k in vocabulary.items() if t[:1] in (BLANK, FEED)]] = True
        self.feed, blank_a, joined = self._ids(["\n", " a", "\na"])
        # Line feeds are cut off the words that they stand before if they are one token.
        if len(self.feed) != 4 or joined != self.feed + self._ids(["a"])[0] or self._ids(["a\n a"]) != [
            self._ids(["a"])[0] + self.feed + blank_a
        ]:
            raise ValueError("this vocabulary has tokens that hold a line feed and a word")

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in found]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, with the blank or line feed before them, and of marks behind them."""
        cores: dict[str, bytes] = {}
        marks: dict[str, bytes] = {"": b""}
        out = []
        for word in words:
            core = word.rstrip(MARKS)
            tail = word[len(core) :]
            if core not in cores:
                lead, text = (self.feed, core[1:]) if core[0] == "\n" else (b"", " " + core)
                ids = [t.id for t in self.tokenize(_as_written(text))]
                cores[core] = lead + np.asarray(ids, "<u4").tobytes()
            if tail not in marks:
                marks[tail] = self._ids([tail])[0]
            out.append(cores[core] + marks[tail])
        return out

    def _many_letters(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same in one array of ids, and where each word starts there."""
        cuts = np.append(np.arange(0, len(words), _TOGETHER, dtype=np.int32), np.int32(len(words)))
        strings = pc.binary_join(pa.ListArray.from_arrays(pa.array(cuts), words), " ").to_pylist()
        strings = [_as_written((" " + s).replace(" \n", "\n")) for s in strings]
        parts = []
        for k in range(0, len(strings), _STRINGS):
            found = self.bare.encode_batch_fast(strings[k : k + _STRINGS], add_special_tokens=False)
            parts += [array("I", e.ids) for e in found]
        ids = np.frombuffer(b"".join(parts), np.uint32)
        at = np.flatnonzero(self.starts[ids])
        if len(at) != len(words):
            raise ValueError("this vocabulary has tokens that hold more than a word")
        return ids, at

    def _learn(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words with the blank or line feed before them: all ids, where each word's are and how many; which words have unusual white space."""
        start, length, odd = (np.zeros(len(words), kind) for kind in (np.int64, np.int64, bool))
        ids = np.empty(0, np.uint32)
        if self.byte_level:
            # Letters alone are one piece for the pre-tokenizer, and so are marks behind them.
            core = pc.utf8_rtrim(pc.utf8_ltrim(words, characters="\n"), characters=MARKS)
            easy = pc.utf8_is_alpha(core).to_numpy(zero_copy_only=False)
        else:
            easy = odd.copy()
        if self.together and len(words) > _FEW:
            ids, at = self._many_letters(words.filter(pa.array(easy)))
            start[easy], length[easy] = at, np.diff(at, append=len(ids))
            easy = ~easy
            alone = [None if _UNUSUAL.search(w) else w for w in words.filter(pa.array(easy)).to_pylist()]
            odd[easy] = [w is None for w in alone]
            raw = self._ids([w if w[:1] == "\n" else " " + w for w in alone if w is not None])
            easy &= ~odd
        else:
            alone = words.to_pylist()
            odd[:] = [not e and bool(_UNUSUAL.search(w)) for w, e in zip(alone, easy)]
            raw = self._letters([w for w, e in zip(alone, easy) if e])
            raw += self._ids([w if w[:1] == "\n" else " " + w for w, e, o in zip(alone, easy, odd) if not e and not o])
            easy = np.concatenate([np.flatnonzero(easy), np.flatnonzero(~easy & ~odd)])
        length[easy] = sizes = np.asarray([len(r) // 4 for r in raw], np.int64)
        start[easy] = len(ids) + np.cumsum(sizes) - sizes
        return np.concatenate([ids, np.frombuffer(b"".join(raw), "<u4")]), start, length, odd

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not len(texts):
            return []
        # Words behind single blanks; a word at the start of a line has the line feed with it.
        lines = pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), "")
        rows = pc.split_pattern(lines, " ")
        coded = rows.flatten().dictionary_encode()
        place, words = coded.indices.to_numpy(), coded.dictionary
        bounds = rows.offsets.to_numpy().astype(np.int64)
        del lines, rows, coded
        whole = np.zeros(len(texts), bool)
        if self.across:
            whole[:] = [any(a in t for a in self.across) for t in texts.to_pylist()]
        # Blanks and line feeds that are not single ones between words leave words without letters.
        odd = pc.is_in(words, pa.array(["", "\n"], words.type)).to_numpy(zero_copy_only=False)
        spaced = np.logical_or.reduceat(odd[place], bounds[:-1]) if odd.any() else np.zeros(len(texts), bool)
        if (spaced | whole).any():
            used = np.zeros(len(words), bool)
            used[place[np.repeat(~(spaced | whole), np.diff(bounds))]] = True
        else:
            used = ~odd
        start, length = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        ids, start[used], length[used], odd[used] = self._learn(words.filter(pa.array(used)))
        if odd[used].any():
            spaced |= np.logical_or.reduceat(odd[place], bounds[:-1])
        size = length[place]
        stop = np.cumsum(size)
        kind = np.int32 if stop[-1] + len(ids) < 1 << 31 else np.int64
        at = np.repeat((start[place] - stop + size).astype(kind), size)
        at += np.arange(len(at), dtype=kind)
        raw = memoryview(ids[at]).cast("B")
        ends = np.append(0, stop)[bounds]
        # The first word came with a line feed that the text has not.
        out = [bytes(raw[4 * a + 4 : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        for k in np.flatnonzero(spaced | whole).tolist():
            out[k] = self._ids([texts[k].as_py()])[0] if whole[k] else self._by_pieces(texts[k].as_py())
        return out

    def _by_pieces(self, text: str) -> bytes:
        """Ids of a text with white space of any kind."""
        if len(self.pieces) > CACHED_PIECES:
            self.pieces = dict(islice(self.pieces.items(), CACHED_PIECES // 2))
        pieces = _PIECE.findall(text)
        missing = list({p for p in pieces if p not in self.pieces})
        self.pieces.update(zip(missing, self._ids(missing)))
        return b"".join(map(self.pieces.__getitem__, pieces))


def _as_written(text: str) -> str:
    """A text as byte-level vocabularies write it."""
    return charmap_decode(text.encode(), "strict", _AS_WRITTEN)[0]


def _over_words(token: str) -> bool:
    """Whether a token of a byte-level vocabulary goes from a word into the next or from letters into marks."""
    text = bytes([_BYTES[c] for c in token]).decode(errors="replace")
    if not text.strip():
        return False
    if " " in text[1:] or "\n" in text[1:] or text[0] == "\n":
        return True
    # Half a letter shows as U+FFFD.
    return any(b in MARKS and (a.isalpha() or a == "\ufffd") for a, b in zip(text, text[1:]))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
