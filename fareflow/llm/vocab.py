"""Public tokenizers inside tasks: files sent once, chunks remembered.

The libraries take several microseconds a byte, so a text is cut at places
where no token can cross, and a worker remembers the ids of the chunks it has
met.  The memory is bounded and changes no result: the oldest half of the
chunks is forgotten when it is full.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from itertools import islice

import numpy as np

from fareflow.llm.common import Shared, worker_state

CHUNKS = 1_000_000
CHUNK_BYTES = 64
_MARKS = b".,;:!?"

# White space of the tokenizers' patterns (the Unicode property), as UTF-8.
_WIDE = [chr(c).encode("utf-8") for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_SPACES = tuple([bytes([c]) for c in b"\t\n\v\f\r "] + _WIDE)
_BEFORE_SPACE = [c + b" " for c in _SPACES]


def shared_file(spark, path: str) -> Shared:
    """A vocabulary file on every executor; its size is the vocabulary's, not the data's."""
    with open(path, "rb") as f:
        return Shared(spark, f.read())


def worker_object(shared: Shared, kind):
    """``kind(bytes)``, built once in a Python worker."""
    return worker_state((shared.name, kind.__name__), lambda: kind(shared.value))


def library(model: bytes, plain: bool = False):
    """A tokenizer of the ``tokenizers`` library that stays on its task's core."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(model.decode("utf-8"))
    t.encode_special_tokens = plain
    return t


def packed(ids: list[int]) -> bytes:
    """Ids as unsigned 32-bit integers."""
    return array("I", ids).tobytes()


class Remembered(dict):
    """Chunk -> what its tokenizer gave, for at most ``limit`` short chunks."""

    def __init__(self, limit: int = CHUNKS):
        super().__init__()
        self.limit = limit

    def look_up(self, texts: list[list[bytes]], learn) -> list[list]:
        """What each chunk of each text gives; chunks not met before are learned together."""
        found = [list(map(self.get, chunks)) for chunks in texts]
        missing = {c for chunks, f in zip(texts, found) if None in f for c, x in zip(chunks, f) if x is None}
        if missing:
            new = learn(sorted(missing))
            for i, chunks in enumerate(texts):
                if None in found[i]:
                    found[i] = [new[c] if x is None else x for c, x in zip(chunks, found[i])]
            self.update((c, x) for c, x in new.items() if len(c) <= CHUNK_BYTES)
            if len(self) > self.limit:
                for c in list(islice(self, len(self) - self.limit // 2)):
                    del self[c]
        return found


class WordEncoder:
    """Ids of a tokenizer that drops white space: its words stand alone.

    No token and no normalisation crosses ASCII white space, which the
    tokenizer's pattern excludes.  Capital ASCII letters are lowered first so
    that more words are alike; that is left out where it could matter (a mark
    that might combine with the letter, a special token's brackets).
    """

    # Characters that keep their number of bytes when the tokenizer normalises them.
    _plain = re.compile(r"[\x21-\x7e\xc0-\xff]+").fullmatch

    def __init__(self, model: bytes):
        self.library = library(model)
        self.known = Remembered()
        end = json.loads(model)["model"]["end_of_word_suffix"] or ""
        tokens = self.library.get_vocab(with_added_tokens=False)
        self.long = np.zeros(max(tokens.values()) + 1, np.int64)  # bytes of the text behind an id
        for t, i in tokens.items():
            self.long[i] = len(t.removesuffix(end))

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words not met before.

        Marks behind letters are tokens of their own, so such a word is its
        letters and its marks, both of which are likely to be known.
        """
        split, new = {}, set()
        for w in words:
            core = w.rstrip(_MARKS)
            if len(core) < len(w) and core.decode("utf-8").isalpha():
                split[w] = core, w[len(core):]
                new.update(x for x in split[w] if x not in self.known)
            else:
                new.add(w)
        out = self._encode_new(sorted(new))
        for w, halves in split.items():
            out[w] = b"".join(out[x] if x in out else self.known[x] for x in halves)
        return out

    def _encode_new(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids by the library; plain words are encoded as one text and told apart by length."""
        texts = [w.decode("utf-8") for w in words]
        plain, other = [], []
        for w, t in zip(words, texts):
            (plain if self._plain(t) and "<" not in t and len(w) <= CHUNK_BYTES else other).append((w, t))
        out = {w: packed(ids) for (w, _), ids in zip(other, self._ids([t for _, t in other]))}
        if plain:
            ids = np.array(self._ids([" ".join(t for _, t in plain)])[0], "<u4")
            ends = np.searchsorted(np.cumsum(self.long[ids]), np.cumsum([len(w) for w, _ in plain])) + 1
            at = 0
            for (w, _), end in zip(plain, ends.tolist()):
                out[w] = ids[at:end].tobytes()
                at = end
        return out

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Packed ids of every text."""
        words = [(t if b"<|" in t or b"\xcc" in t or b"\xcd" in t else t.lower()).split() for t in texts]
        return list(map(b"".join, self.known.look_up(words, self._learn)))


def chunks(raw: bytes) -> list[bytes]:
    """Cut a text at the spaces that follow something other than white space.

    A pattern that keeps white space in front of what follows it starts a new
    token there, whatever the neighbours are.  The space itself is left out:
    every chunk is the part behind the space that opens it, the first one
    behind a space that the caller puts before the text.  A last space alone
    stays with the chunk before it.
    """
    parts = raw.split(b" ")
    if not any(pair in raw for pair in _BEFORE_SPACE) and not raw.startswith(b" "):
        if len(parts) > 1 and not parts[-1]:
            parts[-2:] = [parts[-2] + b" "]
        return parts
    out, whole = [], parts[0]
    for part in parts[1:]:
        if not whole or whole.endswith(_SPACES):  # white space or the opening space stands before this one
            whole += b" " + part
        else:
            out.append(whole)
            whole = part
    if out and not whole:
        out[-1] += b" "
    else:
        out.append(whole)
    return out


class ByteLevel:
    """A byte-level BPE of the ``tokenizers`` library that keeps every byte."""

    def __init__(self, model: bytes):
        self.library = library(model, plain=True)

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def token_bytes(self) -> list[bytes]:
        """The bytes of every id; the printable form of a byte is undone."""
        back = _byte_of_char()
        out = [b""] * self.library.get_vocab_size(with_added_tokens=False)
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            out[i] = bytes(back[c] for c in token) if all(c in back for c in token) else b""
        return out


class Pieces:
    """A sentencepiece BPE with byte fallback; it puts a space before the text itself."""

    def __init__(self, model: bytes):
        import sentencepiece
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.library.get_piece_size()
        # Chunks are encoded alone only if no piece reaches over the start of one.
        if any("▁" in self.library.id_to_piece(i).lstrip("▁") for i in range(size)):
            raise ValueError("a piece of this model holds a space behind other characters")

    def __call__(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)

    def token_bytes(self) -> list[bytes]:
        lib = self.library
        return [b"" if lib.is_control(i) or lib.is_unknown(i)
                else bytes([int(lib.id_to_piece(i)[3:5], 16)]) if lib.is_byte(i)
                else lib.id_to_piece(i).replace("▁", " ").encode("utf-8") for i in range(lib.get_piece_size())]


def _byte_of_char() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte, reversed.

    Printable bytes of Latin-1 stand for themselves, the others follow from
    U+0100 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}
