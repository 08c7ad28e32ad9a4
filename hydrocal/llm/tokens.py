"""Token ids of texts, with the tokenizers library.

BPE works on each pre-token alone, so equal pieces of text always give equal ids. ``Encoder`` cuts
a text before every space, full stop and comma and around every newline, lets the library encode
each distinct piece once, and joins the remembered ids. Cutting there is only exact where no run of
white space is cut in its middle and the stop or comma follows a letter or digit; any other text is
encoded whole by the library.
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NEWLINE = "\n"
STOPS = (".", ",")
#: Byte-level BPE writes each byte as a printable character: itself, or the next one from U+0100 on.
_SHOWN = {b for r in (range(33, 127), range(161, 173), range(174, 256)) for b in r}
_BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_RUN = re.compile(r"\s\s(?:\s|\Z)")


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Encodes texts without special tokens; their strings in a text are ordinary text."""

    LIMIT = 400_000  # remembered pieces; beyond, the half used in the fewest slices is forgotten

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.newline = self.whole(NEWLINE)
        kind = type(self.tok.pre_tokenizer).__name__
        self.by_model = kind == "ByteLevel" and self.tok.normalizer is None
        self.by_model &= all([t.id for t in self.tok.model.tokenize(self._shown(w))] == self.whole(w).tolist() for w in (" the", "word", " \u00e9t\u00e9"))
        self.clear()

    def clear(self) -> None:
        self.no: dict[str, int] = {}
        self.ids = np.zeros(1 << 20, np.int32)
        self.start = np.zeros(1 << 18, np.int64)
        self.size = np.zeros(1 << 18, np.int64)
        self.odd = np.zeros(1 << 18, bool)  # may be part of a longer run of white space
        self.stop = np.zeros(1 << 18, bool)  # begins with a full stop or comma
        self.word = np.zeros(1 << 18, bool)  # ends with a letter or digit
        self.hits = np.zeros(1 << 18, np.int32)
        self.used = 0

    def forget(self) -> None:
        """Keep the pieces that were used most, half of ``LIMIT`` at most."""
        names, n = list(self.no), len(self.no)
        hits = self.hits[:n]
        keep = np.flatnonzero(hits > max(1, np.partition(hits, n - self.LIMIT // 2)[n - self.LIMIT // 2])) if n > self.LIMIT // 2 else np.arange(n)
        size = self.size[keep]
        end = np.cumsum(size)
        ids = self.ids[np.arange(end[-1] if len(end) else 0) + np.repeat(self.start[keep] - (end - size), size)]
        for name in ("size", "odd", "stop", "word", "hits"):
            old = getattr(self, name)
            old[: len(keep)] = old[keep]
        self.start[: len(keep)] = end - size
        self.hits[: len(keep)] //= 2
        self.ids[: len(ids)] = ids
        self.used = len(ids)
        self.no = {names[i]: k for k, i in enumerate(keep.tolist())}

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, np.int32)

    @staticmethod
    def _shown(piece: str) -> str:
        """The piece in the characters that byte-level BPE works on."""
        return piece.replace(" ", "\u0120") if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTE_CHARS)

    def _store(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray, odd: bool) -> None:
        n, k = len(self.no), len(pieces)
        while n + k > len(self.start):
            for name in ("start", "size", "odd", "stop", "word", "hits"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros(len(old), old.dtype)]))
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.int32)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.hits[n : n + k] = 0
        self.start[n : n + k] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + k] = sizes
        self.odd[n : n + k] = odd
        self.stop[n : n + k] = [p[:1] in STOPS for p in pieces]
        self.word[n : n + k] = [p[-1:].isalnum() for p in pieces]
        self.used += len(ids)
        self.no.update(zip(pieces, range(n, n + k)))

    def learn(self, pieces: list[str]) -> None:
        """Encode new pieces: those of letters alone, which are one pre-token, by the library's BPE
        model itself; others in lines of one text, where a newline is sure to separate them."""
        words, ids, sizes, plain, other = [], [], [], [], []
        bpe = self.tok.model.tokenize
        for p in pieces:
            q = p[1:] if p[:1] == " " else p
            if self.by_model and q.isalpha() and max(q) < "\u0500":
                got = [t.id for t in bpe(self._shown(p))]
                words.append(p)
                ids += got
                sizes.append(len(got))
            else:
                (plain if q and not q[0].isspace() and not q[-1].isspace() else other).append(p)
        self._store(words, np.array(ids, np.int32), np.array(sizes, np.int64), False)
        for k in range(0, len(plain), 256):
            part = plain[k : k + 256]
            ids = np.array(self.tok.encode_batch_fast([NEWLINE.join(part)], add_special_tokens=False)[0].ids, np.int32)
            cut = np.flatnonzero(ids == self.newline[0])
            if len(self.newline) == 1 and len(cut) == len(part) - 1:
                ends = np.append(cut, len(ids))
                sizes = np.diff(np.append(-1, ends)) - 1
                self._store(part, np.delete(ids, cut), sizes, False)
            else:
                other += part
        for p in other:
            ids = self.whole(p)
            inner = p != NEWLINE and (p in ("", " ") or any(map(str.isspace, p[1:])) or p[:1].isspace() and p[0] != " ")
            self._store([p], ids, np.array([len(ids)]), inner)

    def encode(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        """The ids of each text (null: none)."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        if not len(texts):
            return []
        cut = pc.replace_substring(pc.fill_null(texts, ""), NEWLINE, "\0\n\0")
        for mark in (" ", *STOPS):
            cut = pc.replace_substring(cut, mark, f"\0{mark}")
        cut = pc.split_pattern(cut, "\0")
        coded = cut.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        k = np.fromiter(map(self.no.get, distinct, repeat(-1)), np.int64, len(distinct))
        if len(new := np.flatnonzero(k < 0).tolist()):
            pieces = [distinct[i] for i in new]
            if len(self.no) + len(new) > self.LIMIT:
                self.forget()
                k = np.fromiter(map(self.no.get, distinct, repeat(-1)), np.int64, len(distinct))
                new = np.flatnonzero(k < 0).tolist()
                pieces = [distinct[i] for i in new]
            self.learn(pieces)
            k[new] = [self.no[p] for p in pieces]
        self.hits[k] += 1
        k = k[coded.indices.to_numpy()]
        piece_at = cut.offsets.to_numpy().astype(np.int64)
        piece_at -= piece_at[0]
        size = self.size[k]
        end = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.arange(end[-1]) + np.repeat(self.start[k] - end[:-1], size)]
        odd = np.concatenate([[0], np.cumsum(self.odd[k])])[piece_at]
        at = end[piece_at]
        glued = self.stop[k]
        glued[1:] &= ~self.word[k[:-1]]
        glued[piece_at[:-1]] = False  # a text's first piece (its pieces are never none)
        glued = np.concatenate([[0], np.cumsum(glued)])[piece_at]
        out = [ids[a:b] for a, b in zip(at, at[1:])]
        nul = pc.fill_null(pc.match_substring(texts, "\0"), False).to_numpy(zero_copy_only=False)
        glued = (np.diff(glued) > 0) | nul
        for i in np.flatnonzero((np.diff(odd) > 0) | glued).tolist():
            x = texts[i].as_py() or ""
            if glued[i] or _RUN.search(x):
                out[i] = self.whole(x)
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
