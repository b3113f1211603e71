"""Token ids of whole texts with the ``tokenizers`` library.

A text is cut at places where the tokenizer's own pre-tokenisation always
ends a piece, so ids of the pieces, joined, are the ids of the text.  Pieces
repeat a lot (they are words), so each Python worker keeps a bounded cache of
piece -> id bytes and asks the library only for pieces not in it.

Where the cuts lie depends on the tokenizer file:

* ``drop``: white space separates words and is dropped (word-end BPE).  Every
  space or line feed is a cut.
* ``prefix``: byte-level BPE with the usual word pattern.  A single space
  between two other characters starts a piece, and a single line feed between
  two other characters is a piece of its own.
* ``whole``: any other tokenizer; texts are encoded as they are.

Ids are those of the library's ``encode`` with ``add_special_tokens=False``, which
takes a control string inside a text for its token: texts that hold one (in any
case) are encoded whole by the library.  A null text counts as empty.

``Encoder.encode`` takes texts one by one.  ``Encoder.batch`` takes an Arrow column: where the rule is
``drop`` or ``prefix``, the texts are cut and their distinct pieces found by Arrow, so that each
piece is looked up once a batch, and ids are gathered by numpy.  Under ``prefix``, texts with other
white space than single spaces and line feeds inside are encoded one by one.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_OTHER_SPACE = re.compile(r"[^\S \n]")
_WORD_START = re.compile(r"(?<=\S)(?= \S)")
_STOPS = (".", ",")
#: Letters and the symbols after them, which the word pattern of byte-level BPE keeps apart (an apostrophe may not be).
_TAILED = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@[-`{-~]+)").fullmatch
_WIDE = ("  ", " \n", "\n ", "\n\n")
#: The texts that ``_prefixed`` cuts at word starts only, for Arrow (whose \\s is ASCII).
_UNEVEN = r"^[ \n]|[ \n]$|[ \n][ \n]|[" + "".join(f"\\x{{{c:x}}}" for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n") + "]"

#: Pieces of half a cache (about 200 bytes each) and the longest one kept.
CACHE_PIECES = 600_000
CACHE_LENGTH = 64
#: Pieces whose ids are gathered at a time.
_GATHERED = 1 << 20


def cut_rule(spec: dict) -> str:
    """Which cut rule of the module text a tokenizer file allows."""
    if spec.get("post_processor") and spec["post_processor"].get("type") not in ("ByteLevel", "RobertaProcessing", "TemplateProcessing"):
        return "whole"
    pre, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
    if pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not norm:
        return "prefix"
    steps = {s.get("type") for s in norm.get("normalizers", [])}
    first = (pre.get("pretokenizers") or [{}])[0]
    if (pre.get("type") == "Sequence" and first.get("type") == "Split" and first.get("invert") and first.get("behavior") == "Removed"
            and steps <= {"NFC", "Replace", "Lowercase"}):
        return "drop"
    return "whole"


def _byte_chars() -> dict[int, str]:
    """The characters byte-level BPE files write for bytes: printable Latin-1
    bytes stand for themselves, the others for code points from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Pieces(dict):
    """Piece -> id bytes; a piece not yet known is encoded when asked for.  A
    full cache becomes the older half, from which pieces in use come back."""

    def __init__(self, find):
        super().__init__()
        self._find, self._older = find, {}

    def __missing__(self, piece: str) -> bytes:
        out = self._older.get(piece)
        if out is None:
            out = self._find(piece, self)
        if len(piece) <= CACHE_LENGTH and not (piece[-1:] in _STOPS and len(piece) > 1):  # those are put together again
            self[piece] = out
        return out

    def trim(self) -> None:
        if len(self) > CACHE_PIECES:
            self._older = dict(self)
            self.clear()


class Encoder:
    """``encode(texts)`` gives the ids of each text as little-endian bytes of
    ``width`` bytes an id (2 if every id fits, else 4)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        self._tok = Tokenizer.from_file(path)
        self._tok.encode_special_tokens = True  # pieces of texts without control strings
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.rule = cut_rule(spec)
        self.control = [t["content"] for t in spec.get("added_tokens", [])]
        self._has_control = re.compile("|".join(map(re.escape, self.control)) or "(?!)", re.IGNORECASE).search
        self.width = 2 if self._tok.get_vocab_size(with_added_tokens=True) <= 65536 else 4
        self._code = "H" if self.width == 2 else "I"
        self._model = self._tok.model
        self._chars = _byte_chars()
        # letters that stay as they are under the file's normalisation, and so are one piece for its BPE model
        self._word = re.compile("[a-zß-öø-ÿ]+" if self.rule == "drop" else "[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
        self._plain = _Pieces(lambda p, known: self._piece(p, known, ""))
        self._spaced = _Pieces(lambda p, known: self._piece(p, known, " "))

    def ids(self, values: Iterable[int]) -> bytes:
        return array(self._code, values).tobytes()

    def _piece(self, piece: str, known: _Pieces, lead: str) -> bytes:
        """A letter and a full stop or comma after it are never in one token,
        so ``word.`` is ``word`` and ``.``; where case is dropped, an ASCII
        piece has the ids of its lower case."""
        if piece[-1:] in _STOPS and piece[-2:-1].lower().isalpha():
            return known[piece[:-1]] + self._plain[piece[-1]]
        if self.rule == "drop" and piece.isascii() and piece != piece.lower():
            return known[piece.lower()]
        if self._word(piece):
            text = lead + piece
            if lead or not piece.isascii():
                text = text.encode().decode("latin-1").translate(self._chars)
            return array(self._code, [t.id for t in self._model.tokenize(text)]).tobytes()
        if self.rule == "prefix" and (parts := _TAILED(piece)):
            return known[parts[1]] + self._plain[parts[2]]
        return self.ids(self._tok.encode(lead + piece, add_special_tokens=False).ids)

    def _trim(self) -> None:
        self._plain.trim()
        self._spaced.trim()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if self.rule == "whole":
            return [self._by_library(t or "") for t in texts]
        one = self._dropped if self.rule == "drop" else self._prefixed
        return [(self._by_library(t) if "<" in t and self._has_control(t) else one(t)) if t else b"" for t in texts]

    def _by_library(self, text: str) -> bytes:
        return self.ids(self._whole.encode(text, add_special_tokens=False).ids)

    def _ids_of(self, pieces: pa.Array) -> list[bytes]:
        """Ids of distinct pieces.  Letters and a run of symbols after them are
        never in one token, so ``word``, ``word.`` and ``Word***`` look up the same word."""
        small = pc.if_else(pc.match_substring_regex(pieces, "^[a-zÀ-ÖØ-öø-ÿ]+[!-&(-/:-@[-`{-~]*$"), pc.utf8_lower(pieces), pieces)
        parts = pc.extract_regex(small, "^(?P<word>[a-zß-öø-ÿ]+)(?P<tail>[!-&(-/:-@[-`{-~]*)$")
        word = pc.struct_field(parts, "word")
        easy = pc.is_valid(word)
        base = pc.if_else(easy, word, small).dictionary_encode()
        tail = pc.fill_null(pc.struct_field(parts, "tail"), "").dictionary_encode()
        found = self._looked_up(base.dictionary)
        tails = self._looked_up(tail.dictionary)
        return [found[b] + tails[t] for b, t in zip(base.indices.to_numpy().tolist(), tail.indices.to_numpy().tolist())]

    def _looked_up(self, pieces: pa.Array) -> list[bytes]:
        words = pieces.to_numpy(zero_copy_only=False).tolist()
        plain = pc.match_substring_regex(pieces, "^[a-zß-öø-ÿ]+$").to_numpy(zero_copy_only=False).tolist()
        known, older, tokens, code = self._plain, self._plain._older, self._model.tokenize, self._code
        out = []
        for w, easy in zip(words, plain):
            x = known.get(w)  # get() adds nothing
            if x is None:
                x = older.get(w)
                if x is None:
                    if easy:
                        text = w if w.isascii() else w.encode().decode("latin-1").translate(self._chars)
                        x = array(code, [t.id for t in tokens(text)]).tobytes()
                    else:
                        x = self.ids(self._tok.encode(w, add_special_tokens=False).ids)
                if len(w) <= CACHE_LENGTH:
                    known[w] = x
            out.append(x)
        known.trim()
        return out

    def _spaced_ids(self, pieces: pa.Array) -> list[bytes]:
        """Ids of distinct pieces after a space; one that starts with a line feed is that and the first word of a line."""
        first, rest = self._plain.__getitem__, self._spaced.__getitem__
        line = first("\n")
        return [line + first(p[1:]) if p[:1] == "\n" else rest(p) if p else b"" for p in pieces.to_pylist()]

    def batch(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """Ids of each text of a string column, and ``end`` after them, as binary."""
        if self.rule == "whole":
            return pa.array([x + end for x in self.encode(texts.to_pylist())], pa.binary())
        drop = self.rule == "drop"
        plain = pc.fill_null(texts, "")
        if drop:
            plain = pc.ascii_lower(plain)
        odd = np.zeros(len(texts), bool)
        for c in self.control:
            odd |= pc.match_substring(plain, c.lower(), ignore_case=True).to_numpy(zero_copy_only=False)
        if not drop:
            odd |= pc.match_substring_regex(plain, _UNEVEN).to_numpy(zero_copy_only=False)
        if odd.any():
            plain = pc.if_else(pa.array(odd), "", plain)
        cut = pc.split_pattern(pc.replace_substring(plain, "\n", " " if drop else " \n"), " ")
        pieces = cut.flatten().dictionary_encode()
        edges = np.asarray(cut.offsets) - cut.offsets[0].as_py()
        ends, codes = edges[1:], pieces.indices.to_numpy()
        if drop:
            found = self._ids_of(pieces.dictionary)
        else:
            self._trim()
            found = self._spaced_ids(pieces.dictionary)
            # the first word of a text has no space before it
            codes = codes.copy()
            own, at = np.unique(codes[edges[:-1]], return_inverse=True)
            codes[edges[:-1]] = len(found) + at
            found += [self._plain[p] if p else b"" for p in pieces.dictionary.take(pa.array(own)).to_pylist()]
        first = len(found)  # after the pieces: the end of a text, and texts encoded one by one
        found.append(end)
        more = np.full(len(texts), first)
        for r in np.flatnonzero(odd):
            more[r] = len(found)
            found.append(self.encode([texts[r].as_py()])[0] + end)
        codes = np.insert(codes, ends, more)
        size = np.array([len(x) // self.width for x in found], np.int64)
        start = np.concatenate([[0], np.cumsum(size)[:-1]])
        ids = np.frombuffer(b"".join(found), f"<u{self.width}")
        out, total = [], np.cumsum(size[codes])
        for lo in range(0, len(codes), _GATHERED):
            part = codes[lo:lo + _GATHERED]
            n = size[part]
            at = np.arange(int(n.sum())) + np.repeat(start[part] - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
            out.append(ids[at])
        offsets = np.concatenate([[0], total[ends + np.arange(len(ends))]]) * self.width
        data = pa.py_buffer(np.concatenate(out).tobytes() if out else b"")
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets.astype(np.int32)), data])

    def _dropped(self, text: str) -> bytes:
        self._trim()
        return b"".join(map(self._plain.__getitem__, text.replace("\n", " ").split(" ")))

    def _prefixed(self, text: str) -> bytes:
        self._trim()
        first, rest = self._plain.__getitem__, self._spaced.__getitem__
        if text[0] in " \n" or text[-1] in " \n" or any(w in text for w in _WIDE) or _OTHER_SPACE.search(text):
            return b"".join(map(first, _WORD_START.split(text)))
        out = []
        for line in text.split("\n"):
            words = line.split(" ")
            out.append(first(words[0]) + b"".join(map(rest, words[1:])))
        return first("\n").join(out)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file (loaded once a worker)."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
