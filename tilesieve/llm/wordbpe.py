"""Exact ids of a lower-casing word BPE (tokenizers JSON), at the cost of one lookup per word.

The tokenizer drops white space and its pieces never cross it, so the ids of a text are those of
its white-space separated chunks one after the other.  A chunk is encoded once per process and
then found in a bounded table.  Chunks of printable ASCII and Latin-1 letters, for which the
normaliser only lower-cases, are merged by ``tiktoken`` with ranks built from the vocabulary; all
others go to ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re

import numpy as np

from .common import process_state

# White space on which both Python and the tokenizer surely agree, and all that is special to one.
_SURE = re.compile(r"[ \t\n\r]+")
_UNSURE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
# Chunks whose normal form is their lower case: printable ASCII, and the letters of Latin-1.
_PLAIN = "[!-~À-ÖØ-öø-ÿ]{1,100}"
# The split pattern of the vocabulary, restricted to those characters.
_PIECES = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\na-zß-öø-ÿ0-9]+")
# Chunks, and lower-case words, that a process keeps at most; a table starts again beyond.
MAX_KNOWN = 200_000


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: letter to byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["end_of_word_suffix"] != "</w>" or spec["normalizer"]["normalizers"][-1]["type"] != "Lowercase":
            raise ValueError(f"{path} is not a lower-casing BPE with word ends")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = self.library.get_vocab_size()
        self.tokens = [self.library.id_to_token(i) or "" for i in range(size)]
        letters = _byte_letters()
        ranks = {}
        self.ends = np.zeros(size, bool)
        for token, i in spec["model"]["vocab"].items():
            if token in self.special:
                continue
            end = token.endswith("</w>") and token != "</w>"
            # The end of a word is the byte 0: it joins the last byte before any other merge.
            ranks[bytes(letters[c] for c in (token[:-4] if end else token)) + b"\0" * end] = i
            self.ends[i] = end
        self.merges = tiktoken.Encoding("words", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        special = "|".join(map(re.escape, self.special)) or "(?!)"
        self.is_plain = re.compile(f"(?!.*(?:{special})){_PLAIN}").fullmatch

    @classmethod
    def of(cls, path: str) -> WordBpe:
        """The encoder of this process for a file."""
        held = process_state().setdefault("word_bpe", {})
        if path not in held:
            held[path] = cls(path)
        return held[path]

    @staticmethod
    def chunks(text: str) -> list[str]:
        if _UNSURE.search(text):
            return [c for c in _SURE.split(text) if c]
        return text.split()

    def _encode_plain(self, chunks: list[str]) -> list[bytes]:
        """Ids of lower-case chunks."""
        pieces = _PIECES.findall("\n".join(chunks))
        counts, n = [], 0
        for p in pieces:
            if p == "\n":
                counts.append(n)
                n = 0
            else:
                n += 1
        counts.append(n)
        ids = np.array(self.merges.encode_ordinary("\0".join(p for p in pieces if p != "\n") + "\0"), np.uint32)
        piece_end = np.flatnonzero(self.ends[ids]) + 1
        at = np.concatenate([[0], piece_end[np.cumsum(counts) - 1]]) * 4
        data = ids.astype("<u4").tobytes()
        return [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]

    def _plain(self, chunks: list[str]) -> list[bytes]:
        """Ids of plain chunks: lower case, and a last full stop or comma apart from its word."""
        low = "\n".join(chunks).lower().split("\n")
        tail = [c[-1] if c[-1] in ".," and c[-2:-1].isalnum() else "" for c in low]
        words = [c[:-1] if t else c for c, t in zip(low, tail)]
        new = list({*words, ".", ","}.difference(self.words))
        if len(self.words) + len(new) > MAX_KNOWN:
            self.words, new = {}, list({*words, ".", ","})
        for at in range(0, len(new), 4096):
            part = new[at : at + 4096]
            self.words.update(zip(part, self._encode_plain(part)))
        known = self.words
        end = {"": b"", ".": known["."], ",": known[","]}
        return [known[w] + end[t] for w, t in zip(words, tail)]

    def _learn(self, new: list[str]) -> None:
        """Put the ids of new chunks into the table."""
        if len(self.known) + len(new) > MAX_KNOWN:
            self.known = {}
        plain = [c for c in new if self.is_plain(c)]
        if plain:
            self.known.update(zip(plain, self._plain(plain)))
        if len(plain) < len(new):
            other = [c for c in new if not self.is_plain(c)]
            found = self.library.encode_batch_fast(other, add_special_tokens=False)
            self.known.update((c, np.array(e.ids, "<u4").tobytes()) for c, e in zip(other, found))

    def entries(self, lists: list[list[str]]) -> list[list[bytes]]:
        """The ids of each chunk of each list, as little-endian unsigned 32-bit integers."""
        get = self.known.get
        here = {c: get(c) for c in set().union(*lists)}  # small enough for the processor's cache
        new = [c for c, ids in here.items() if ids is None]
        if new:
            self._learn(new)
            here.update((c, self.known[c]) for c in new)
        find = here.__getitem__
        return [list(map(find, chunks)) for chunks in lists]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        return [b"".join(e) for e in self.entries([self.chunks(t) for t in texts])]

    def decode(self, ids: bytes) -> str:
        """The tokens with a space between, special ones included: the library's decode without a decoder."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])
