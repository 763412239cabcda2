"""Token ids of whole texts by a public tokenizer file, with the ids of repeated words kept in each task.

Both files used here split texts at white space before anything else, so the ids of a text are the ids of its
white-space separated pieces, one after the other; for the byte-level file the blank ahead belongs to the piece.
Each task keeps the ids of the pieces it has met and asks the tokenizer for new ones only.  A piece of Latin letters is
one word to both files, so it goes straight to the tokenizer's model, in the model's letters for bytes.  Other new
pieces go to the tokenizer as one text, with a separator between them that is one id by itself; so the ids are cut
apart again at that id.
"""

from __future__ import annotations

import os
import re
from array import array
from codecs import charmap_decode
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np

# The characters that \s stands for in the tokenizers' patterns.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
BYTE_PIECES = re.compile(f" ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
WORD_PIECES = re.compile(f"[^{_SPACE}]+")
# Letters up to U+00FF: composed, and changed to lower case alike everywhere.
_LATIN = "A-Za-zÀ-ÖØ-öø-ÿ"
_LETTERS = re.compile(f" ?[{_LATIN}]+")
_LETTER = frozenset(chr(k) for k in range(256) if _LETTERS.fullmatch(chr(k)))
_MARKS = ".,;:!?#*$%&|<>"
_SAMPLE = ("word", "Eulenspiegel", "ÀÉÎõüßÿæØ", "xqzvkj", "Straße", "élève", "a" * 30)
# Kept pieces take about 300 bytes each in every Python worker, beside what earlier steps left there.
KEPT_PIECES, KEPT_CHARS = 200_000, 64
# Texts that are cut into pieces at once (up to one that goes beyond the characters), and pieces that are encoded at once.
SLICE_TEXTS, SLICE_CHARS, SLICE_PIECES = 2_000, 4_000_000, 20_000

_made: dict[tuple[str, bool], PieceTokenizer] = {}


def _byte_letters() -> str:
    """The character that stands for each byte in byte-level vocabularies."""
    same = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return "".join(chr(byte if byte in same else next(other)) for byte in range(256))


_BYTE_LETTERS = _byte_letters()


def _is_word(piece: str) -> bool:
    if piece.isascii():
        return piece.isalpha() or piece[0] == " " and piece[1:].isalpha()
    return _LETTERS.fullmatch(piece) is not None


def _words(text: str) -> list[str]:
    """Pieces of WORD_PIECES; ``split`` also cuts at four separators that the tokenizer's white space lacks."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return WORD_PIECES.findall(text)
    return text.split()


def slices(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """First and last (exclusive) place of runs of texts whose pieces may be held together."""
    begin = size = 0
    for at, text in enumerate(texts):
        size += len(text) if text else 0
        if size >= SLICE_CHARS or at - begin + 1 == SLICE_TEXTS:
            yield begin, at + 1
            begin, size = at + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def piece_tokenizer(file: str, white_space_counts: bool) -> PieceTokenizer:
    """The tokenizer of this Python worker; later tasks of the worker go on with the pieces it keeps."""
    key = (file, white_space_counts)
    if key not in _made:
        _made[key] = PieceTokenizer(file, white_space_counts)
    return _made[key]


class PieceTokenizer:
    """Ids of texts.  Up to ``KEPT_PIECES`` short pieces that repeat stay, so memory is bounded and frequent words are kept."""

    def __init__(self, file: str, white_space_counts: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(file) if os.sep not in file else file)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.find = BYTE_PIECES.findall if white_space_counts else _words
        # Without white space in the ids, a control character stands between the pieces.
        self.mark, self.between = ("\n", "\n") if white_space_counts else ("\x01", " \x01 ")
        self.mark_ids = self.tokenizer.encode(self.mark, add_special_tokens=False).ids
        self.known: dict[str, bytes] = {}
        self.split = self.tokenizer.model.tokenize
        normalizer = self.tokenizer.normalizer
        self.lower = normalizer is not None and normalizer.normalize_str("É") == "é"
        # Files with other rules for letters go without the short way.
        self.short_way = all(self._word(w) == ids for w, ids in self._alone(list(_SAMPLE)).items())

    def _word(self, piece: str) -> bytes:
        text, _ = charmap_decode((piece.lower() if self.lower else piece).encode(), "strict", _BYTE_LETTERS)
        return array("I", [token.id for token in self.split(text)]).tobytes()

    def _alone(self, new: list[str]) -> dict[str, bytes]:
        codes = self.tokenizer.encode_batch_fast(new, add_special_tokens=False)
        return {piece: array("I", code.ids).tobytes() for piece, code in zip(new, codes)}

    def _encode(self, new: list[str]) -> dict[str, bytes]:
        found = {p: self._word(p) for p in new if _is_word(p)} if self.short_way else {}
        new = [p for p in new if p not in found]
        for at in range(0, len(new), SLICE_PIECES):
            part = new[at:at + SLICE_PIECES]
            # White space would run into the separator, and a mark inside a piece would be taken for one.
            joined = [p for p in part if self.mark not in p and not p.isspace()] if len(self.mark_ids) == 1 else []
            code = self.tokenizer.encode_batch_fast([self.between.join(joined)], add_special_tokens=False)[0]
            ids = np.array(code.ids, np.uint32)
            edges = np.flatnonzero(ids == self.mark_ids[0]) if joined else ids
            if len(edges) != len(joined) - 1:
                found.update(self._alone(part))
                continue
            raw, ends = ids.tobytes(), [*(4 * edges).tolist(), 4 * len(ids)]
            for piece, begin, end in zip(joined, [0, *[e + 4 for e in ends]], ends):
                found[piece] = raw[begin:end]
            if len(joined) < len(part):
                found.update(self._alone([p for p in part if p not in found]))
        return found

    def _learn(self, missing: Counter[str]) -> dict[str, bytes]:
        """Ids of pieces that are not kept.  Words met more than once stay: most others do not come back.

        Marks behind a letter are pieces of their own to the tokenizer, too, and are put together again for each slice.
        """
        cut, times = {}, {}
        for piece, n in missing.items():
            if piece[-1] in _MARKS and (word := piece.rstrip(_MARKS))[-1:] in _LETTER:
                cut[piece] = parts = word, piece[len(word):]
                for part in parts:
                    if part not in self.known:
                        times[part] = times.get(part, 0) + n
            else:
                times[piece] = times.get(piece, 0) + n
        found = self._encode(list(times))
        made = {piece: b"".join([found.get(p) or self.known[p] for p in parts]) for piece, parts in cut.items()}
        room = KEPT_PIECES - len(self.known)
        if room:
            often = [p for p, n in times.items() if n > 1 and len(p) <= KEPT_CHARS]
            self.known.update((p, found[p]) for p in often[:room])
        return found | made

    def ids(self, texts: Sequence[str | None]) -> list[np.ndarray]:
        """uint32 ids of each text; NULL is empty."""
        out = []
        for begin, end in slices(texts):
            codes, holes = [], []
            for text in texts[begin:end]:
                pieces = self.find(text) if text else []
                code = list(map(self.known.get, pieces))
                codes.append(code)
                holes.append([p for p, c in zip(pieces, code) if c is None] if None in code else ())
            missing = Counter(chain.from_iterable(holes))
            new = self._learn(missing) if missing else {}
            for code, unknown in zip(codes, holes):
                if unknown:
                    fill = map(new.__getitem__, unknown)
                    code = [next(fill) if c is None else c for c in code]
                out.append(np.frombuffer(b"".join(code), np.uint32))
        return out
