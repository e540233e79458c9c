"""Public tokenizers with a memo of the pieces that recur.

Both libraries never merge across a space that a visible character follows, so a text is
the concatenation of its space-led words, and a worker remembers what it has encoded. What
does not fit that rule (runs of spaces, spaces before other white space) goes to the
library in longer pieces or whole.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import re
from collections.abc import Sequence
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rollbook.llm.shared import per_worker

#: Words of a generation, and the longest word worth remembering: at most about 80 MB a memo.
MEMO_WORDS, MEMO_CHARS = 200_000, 48
#: Places in which a memo marks the words it has met once.
MARKS = 1 << 21
#: Marks that may follow a word without changing how its letters are cut off.
_AFTER = ".,;:!?*&%$#|"
#: Those of them that are words of their own where one stands between a letter or digit and a
#: space, and what a word without a space in front begins with meanwhile.
_APART, _BARE = ".,;:!?", "\1"
#: A line feed between two visible characters; a mark that has been set apart from others.
_FEED = re.compile(r"\n(?<=\S\n)(?=\S)")
_TOGETHER = re.compile(rf" {_BARE}(?<![A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f] {_BARE})(?=[{_APART}] )")


class _NotAWord(Exception):
    pass


def version_digest(path: str) -> str:
    """Digest of the vocabulary file and of the library that reads it."""
    library = "tokenizers" if path.endswith(".json") else "sentencepiece"
    h = hashlib.sha256(Path(path).read_bytes())
    h.update(f"{library} {importlib.metadata.version(library)}".encode())
    return h.hexdigest()


class _Memo(dict):
    """Word -> what ``make`` gives for it. A word is remembered when it comes again, as most
    words of a large corpus never do; of two generations the older is forgotten when the
    younger is full, so words that recur stay. Lives as long as its worker."""

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.older: dict = {}
        self.met, self.marked = bytearray(MARKS), 0

    def __missing__(self, word: str):
        value = self.older.get(word)
        if value is None:
            value = self.make(word)
            at = hash(word) & (MARKS - 1)
            if not self.met[at]:
                self.met[at] = 1
                self.marked += 1
                if self.marked > MARKS // 2:
                    self.met, self.marked = bytearray(MARKS), 0
                return value
        if len(word) <= MEMO_CHARS:
            if len(self) >= MEMO_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = value
        return value


class ByteBpe:
    """Ids of a ``tokenizers`` file, as little-endian unsigned 32-bit bytes."""

    _EDGE = re.compile(r" (?=\S)")

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.library = Tokenizer.from_file(path)
        # Only for this kind of file is a space before a visible character a sure edge.
        pre = self.library.pre_tokenizer
        added = self.library.get_added_tokens_decoder().values()
        spaced = any(set(f" \n{_APART}{_BARE}") & set(x.content) or x.lstrip or x.rstrip for x in added)
        self.by_words = (
            self.library.normalizer is None and isinstance(pre, ByteLevel)
            and not pre.add_prefix_space and pre.use_regex and not spaced
        )
        self.model = self.library.model
        # The library's own printable stand-ins of the 256 bytes.
        cut = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        low = {i: cut(chr(i))[0][0] for i in range(128)}
        high = {i: cut(bytes([0xC2 + (i >= 0xC0), 0x80 | i & 0x3F]).decode())[0][0][1] for i in range(128, 192)}
        lead = {i: cut(bytes([i, 0x80]).decode())[0][0][0] for i in range(0xC2, 0xCA)}
        self.shown = low | high | lead
        self.space = low[ord(" ")]
        self.as_bytes = [i.to_bytes(4, "little") for i in range(self.library.get_vocab_size())]
        self.head = _Memo(self._cut)
        self.pieces = _Memo(self._piece)
        self.rest = _Memo(self._after_space)

    def _encode(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()

    def _after_space(self, word: str) -> bytes | None:
        """None where ``word`` is no word: a space before white space is no sure edge."""
        if word.isalpha():
            if word.isascii():  # shown as it stands
                return self._ids(self.space + word)
            if max(word) < "\u0250":
                return self._piece(" " + word)
        if word.startswith(_BARE):
            return self._cut(word[1:])
        if not word or word[0].isspace():
            return None
        return self._cut(word, " ")

    def _cut(self, word: str, lead: str = "") -> bytes:
        """Letters, then marks, then perhaps one line feed and more: pieces of the
        library's own splitting rule, so its model may have them one by one."""
        before, feed, after = word.partition("\n")
        core = before.rstrip(_AFTER)
        simple = core.isalpha() and max(core) < "\u0250"
        if not simple or feed and not after[:1].isalpha():
            return self._encode(lead + word)
        if core == word:  # remembered by whoever asks
            return self._piece(lead + core)
        start = self.rest[core] if lead and core.isascii() else self.pieces[lead + core]
        ids = start + (self.pieces[before[len(core) :]] if core != before else b"")
        return ids + self.pieces["\n"] + self._cut(after) if feed else ids

    def _piece(self, text: str) -> bytes:
        return self._ids(text.encode().decode("latin-1").translate(self.shown))

    def _ids(self, shown: str) -> bytes:
        of = self.as_bytes
        return b"".join([of[t.id] for t in self.model.tokenize(shown)])

    @staticmethod
    def _apart(text: str) -> str:
        """The text with line feeds and marks as words of their own, so that a word is
        remembered once and not with each mark that follows it."""
        if "\n" in text:
            text = _FEED.sub(f" {_BARE}\n {_BARE}", text)
        for mark in _APART:
            text = text.replace(f"{mark} ", f" {_BARE}{mark} ")
        return _TOGETHER.sub("", text)

    def encode(self, text: str) -> bytes:
        if not self.by_words or _BARE in text:
            return self._encode(text)
        first, *rest = self._apart(text).split(" ")
        found = [self.head[first], *map(self.rest.__getitem__, rest)]
        if None in found:
            first, *rest = self._EDGE.split(text)
            found = [self.head[first], *map(self.rest.__getitem__, rest)]
        return b"".join(found)

    def encode_all(self, texts: Sequence[str]) -> list[bytes]:
        """As :meth:`encode` for each text; a word that several of them have is looked up once."""
        if not self.by_words:
            return [self._encode(text) for text in texts]
        apart = ["" if _BARE in text else _BARE + self._apart(text) for text in texts]
        split = pc.split_pattern(pa.array(apart, pa.large_string()), " ")
        words = split.flatten().dictionary_encode()
        known = np.empty(len(words.dictionary), dtype=object)
        known[:] = list(map(self.rest.__getitem__, words.dictionary.to_numpy(zero_copy_only=False)))
        at, ends = words.indices.to_numpy(), split.offsets.to_pylist()
        out = []
        for text, a, b in zip(texts, ends, ends[1:]):
            found = known[at[a:b]].tolist()
            out.append(self.encode(text) if None in found else b"".join(found))
        return out

    def sentence_ends(self) -> np.ndarray:
        """For each id: whether its text ends a sentence or a line."""
        ends = np.zeros(max(self.library.get_vocab_size(), 1), dtype=bool)
        for i in range(len(ends)):
            text = self.library.decode([i], skip_special_tokens=False)
            ends[i] = text.endswith((".", "!", "?", "\n", "。", "！", "？"))
        return ends


class PieceBpe:
    """Token counts of a ``sentencepiece`` file."""

    _MARK = "▁"

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        pieces = (self.library.id_to_piece(i) for i in range(size))
        # No piece goes on after a word's end, white space is kept, and each text gets
        # one mark in front: then words are counted apart.
        self.by_words = (
            not any(self._MARK in p.lstrip(self._MARK) for p in pieces)
            and len(self._count_of(" a ")) == 3 and len(self._count_of("a  b")) == 3
            and self.library.encode("½ x", out_type=str)[-1] == "x"
        )
        self.words = _Memo(self._word)

    def _count_of(self, text: str) -> list[int]:
        return self.library.encode(text)

    def _word(self, word: str) -> int:
        if not word:
            raise _NotAWord
        return len(self.library.encode(word))

    def count(self, text: str) -> int:
        if not text:
            return 0
        if self.by_words and self._MARK not in text:
            try:
                return sum(map(self.words.__getitem__, text.split(" ")))
            except _NotAWord:
                pass
        return len(self.library.encode(text))


class JsonCounter:
    def __init__(self, path: str):
        self.bpe = ByteBpe(path)

    def count(self, text: str) -> int:
        return len(self.bpe.encode(text)) // 4


def byte_bpe(path: str) -> ByteBpe:
    return per_worker(("byte bpe", path), lambda: ByteBpe(path))


def counter(path: str) -> PieceBpe | JsonCounter:
    kind = JsonCounter if path.endswith(".json") else PieceBpe
    return per_worker(("counter", path), lambda: kind(path))
