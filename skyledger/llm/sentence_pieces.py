"""SentencePiece encoding and decoding with a batched numpy Viterbi.

A text is cut before its spaces, and longer stretches without a space between any two
characters that no piece holds side by side: no piece crosses there. Distinct words of
equal length advance together: rolling hashes of all their substrings probe the sorted
keys of the pieces, a hit is confirmed by a second hash, and at each position the
vectorised maximum over the pieces that end there is kept with a backpointer. A word of
more than ``ALONE`` characters rarely has another of its length; it advances on its own
by the same steps.

The vocabulary file is a BPE model, whose encoding is not the best sum of scores but
what merging the best-scored pair again and again gives. That encoding is the one
path whose neighbouring pieces are each what merging gives for the two of them
together: a merge across the border of two pieces would depend on nothing else. So a
step of the Viterbi from one piece to the next is allowed only if that holds; one path
is left for every prefix, and ids are those of the ``sentencepiece`` library (tests
compare both on whole tables). Whether it holds is found for many pairs at once, by
undoing the later of the two pieces' last merges until a merge across the border would
have come first, and kept in a table of fixed size.

Characters that are no piece become their UTF-8 bytes. The pass is narrow; each worker
remembers words of a bounded number of characters.

Cases: a null or empty text has no ids and decodes to an empty text. A literal U+2581
decodes to a space, as in the library. Repeated rows give a row each, an empty table
none; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.arrow import map_slices, texts

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Characters of the words that a worker remembers, about.
REMEMBERED = 6_000_000
#: Places for pairs of pieces; a power of two.
PAIRS = 1 << 21
#: Words that advance together, at most, and texts whose words are learnt together.
TOGETHER = 4096
TEXTS_TOGETHER = 2048
#: Stretches beyond this are cut where no piece crosses; words beyond it go alone.
ALONE = 96
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)
_FREE = -2  # a character of no piece: nothing merges with it


class Vocabulary:
    """Pieces of a model, and which of them merging gives for their own text."""

    def __init__(self, pieces: list[str], scores: list[float], bytes_: list[int], special: list[int]):
        self.pieces, self.bytes, self.special = pieces, bytes_, set(special)
        apart = self.special | {b for b in bytes_ if b >= 0}
        self.rank = {p: s for i, (p, s) in enumerate(zip(pieces, scores)) if i not in apart}
        self.ids = {p: i for i, p in enumerate(pieces) if i not in apart}
        # Characters that occur in pieces without being one take part in merges too.
        self.loose = sorted({c for p in self.rank for c in p} - set(self.rank))
        for c in self.loose:
            self.ids[c] = len(self.pieces)
            self.pieces = [*self.pieces, c]
        if any(not re.fullmatch(f"{SPACE}*[^{SPACE}]*", p) for p in self.rank):
            raise ValueError("a piece holds a space after another character")
        self.longest = max(map(len, self.ids), default=1)
        whole = [self.merged(p) == [p] if p in self.ids else False for p in self.pieces]
        self.valid = np.array(whole, dtype=bool)
        # Runs of spaces may have one score; among other merges the order is strict.
        self.opens = np.array([p.startswith(SPACE) for p in self.pieces])
        self.closes = np.array([p.endswith(SPACE) for p in self.pieces])
        runs = {x for p, x in self.rank.items() if not p.strip(SPACE)}
        made = [x for p, x in self.rank.items() if len(p) > 1 and p.strip(SPACE)]
        if len(set(made) - runs) < len(made):
            raise ValueError("two merges have one score")
        self._undo()
        pairs = {c for p in self.ids for c in zip(p, p[1:])}
        self.inside = np.array(sorted((ord(a) << 32) | ord(b) for a, b in pairs), dtype=np.int64)

    def _undo(self) -> None:
        """When each whole piece is made, single characters first, and of which two."""
        order = sorted(self.rank, key=self.rank.get, reverse=True)
        self.made = np.full(len(self.pieces), -1, dtype=np.int64)
        self.left, self.right = (np.arange(len(self.pieces)) for _ in range(2))
        for i, p in enumerate(order):
            at = self.ids[p]
            if len(p) > 1 and self.valid[at]:
                a, b = self.merged(p, last=True)
                self.made[at], self.left[at], self.right[at] = i, self.ids[a], self.ids[b]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = [i for i in range(n) if sp.is_control(i) or sp.is_unknown(i)]
        if not all(map(sp.is_byte, byte)):
            raise ValueError("the model has no bytes to fall back on")
        found = cls(
            [sp.id_to_piece(i) for i in range(n)], [sp.get_score(i) for i in range(n)], byte, special
        )
        # The model must not normalise or cut in ways that are not built here.
        encoder = Encoder(found)
        for probe in ("a", "  two  spaces ", "\ttab\nline", "ﬁ ½ É é", "\U0001f600 <s>"):
            if encoder.encode([probe])[0].tolist() != sp.encode(probe):
                raise ValueError("the model encodes in a way that is not supported")
        return found

    def merged(self, text: str, last: bool = False) -> list[str]:
        """What merging gives; with ``last``, the parts before the last merge."""
        rank, parts = self.rank, list(text)
        while len(parts) > 1 + last:
            best, place = None, -1
            for i in range(len(parts) - 1):
                score = rank.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, place = score, i
            if place < 0:
                break
            parts[place : place + 2] = [parts[place] + parts[place + 1]]
        return parts


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        v = self.vocabulary = vocabulary
        self._powers, self._second_powers = (
            np.array([pow(int(b), i, 1 << 64) for i in range(v.longest + 1)], dtype=np.uint64)
            for b in (_BASE, _SECOND)
        )
        # The hash of every piece, and per length the sorted keys with both hashes and ids.
        self.hash = np.zeros(len(v.pieces), dtype=np.uint64)
        self.length = np.array([len(p) for p in v.pieces], dtype=np.int64)
        self.by_length = {}
        for width in range(1, v.longest + 1):
            names = [p for p in v.ids if len(p) == width]
            if names:
                codes, ids = _codes(names), np.array([v.ids[p] for p in names], dtype=np.int64)
                keys = _prefixes(codes, _BASE)[:, -1]
                self.hash[ids] = keys
                order = np.argsort(keys)
                second = _prefixes(codes, _SECOND)[:, -1]
                self.by_length[width] = keys[order], second[order], ids[order]
        everything = [np.concatenate(x) for x in zip(*self.by_length.values())]
        order = np.argsort(everything[0])
        self.keys, self.key_ids = everything[0][order], everything[2][order]
        self.score = np.array([v.rank.get(p, -1e9) for p in v.pieces])
        self._words: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}
        self._held = 0
        self._pair_keys = np.full(PAIRS, -1, dtype=np.int64)
        self._pair_allowed = np.zeros(PAIRS, dtype=bool)

    def _found(self, prefix: np.ndarray, second: np.ndarray, width: int) -> np.ndarray:
        """The piece that each substring of a length is, or -1."""
        shape = len(prefix), prefix.shape[1] - width
        if width not in self.by_length:
            return np.full(shape, -1, dtype=np.int64)
        keys, seconds, ids = self.by_length[width]
        hashes = prefix[:, width:] - prefix[:, :-width] * self._powers[width]
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        row, col = np.nonzero(keys[at] == hashes)
        again = second[row, col + width] - second[row, col] * self._second_powers[width]
        sure = seconds[at[row, col]] == again
        out = np.full(shape, -1, dtype=np.int64)
        row, col = row[sure], col[sure]
        out[row, col] = ids[at[row, col]]
        return out

    def _allowed(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether merging leaves each pair of pieces as it is."""
        keys = (before << 32) | after
        mixed = keys.astype(np.uint64) * _BASE
        place = (mixed >> np.uint64(32)).astype(np.int64) & (PAIRS - 1)
        out = self._pair_allowed[place]
        missing = np.flatnonzero(self._pair_keys[place] != keys)
        if len(missing):
            new, where = np.unique(keys[missing], return_inverse=True)
            found = self._decided(new >> 32, new & 0xFFFFFFFF)
            out[missing] = found[where]
            self._pair_keys[place[missing]] = keys[missing]
            # Two keys may claim one place; the one that holds it must be its own.
            held = self._pair_keys[place[missing]] == keys[missing]
            self._pair_allowed[place[missing[held]]] = out[missing[held]]
        return out

    def _decided(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """``_allowed`` of pairs that are not in the table."""
        v, out = self.vocabulary, np.zeros(len(a), dtype=bool)
        spaces = v.closes[a] & v.opens[b]
        for i in np.flatnonzero(spaces).tolist():
            one, other = v.pieces[a[i]], v.pieces[b[i]]
            out[i] = v.merged(one + other) == [one, other]
        at = np.flatnonzero(v.valid[a] & v.valid[b] & ~spaces)
        a, b = a[at], b[at]
        limit = np.full(len(at), np.iinfo(np.int64).max)
        while len(at):
            size = self.length[b]
            both = self.hash[a] * self._powers[np.minimum(size, v.longest)] + self.hash[b]
            key = np.minimum(np.searchsorted(self.keys, both), len(self.keys) - 1)
            across = self.key_ids[key]
            hit = (self.keys[key] == both) & (self.length[across] == self.length[a] + size)
            hit &= v.made[across] >= 0
            open_ = ~(hit & (v.made[across] < limit))
            undo_left = v.made[a] > v.made[b]
            done = open_ & (v.made[a] < 0) & (v.made[b] < 0)
            out[at[done]] = True
            # Of equal merges the one on the left comes first.
            limit = np.where(undo_left, v.made[a], v.made[b] + 1)
            a, b = np.where(undo_left, v.right[a], a), np.where(undo_left, b, v.left[b])
            go = open_ & ~done
            at, a, b, limit = at[go], a[go], b[go], limit[go]
        return out

    def _alone(self, word: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``_viterbi`` of one long word: the one path that is left for each prefix."""
        v, ids, n = self.vocabulary, self.vocabulary.ids, len(word)
        valid, allowed = v.valid, {}
        last, back = [_FREE] * (n + 1), [0] * (n + 1)
        for end in range(1, n + 1):
            for width in range(min(v.longest, end), 0, -1):
                piece = ids.get(word[end - width : end], _FREE if width == 1 else -1)
                if piece == -1:
                    continue
                before = last[end - width]
                if width == end:
                    good = piece == _FREE or valid[piece]
                elif piece == _FREE or before == _FREE:
                    good = True
                else:
                    good = allowed.get((before, piece))
                    if good is None:
                        good = bool(self._allowed(np.array([before]), np.array([piece]))[0])
                        allowed[before, piece] = good
                if good:
                    last[end], back[end] = piece, width
                    break
            else:
                raise ValueError("a word has no encoding")
            if len(allowed) > PAIRS:
                allowed.clear()
        ends, end = [], n
        while end:
            ends.append(end)
            end -= back[end]
        ends = np.array(ends[::-1], dtype=np.int64)
        return np.array(last, dtype=np.int64)[ends], ends, np.array([len(ends)])

    def _viterbi(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces of words of one length, one word after another, ``_FREE`` for none.

        Also where each piece ends, and the number of pieces of each word.
        """
        v, n, size = self.vocabulary, len(words), len(words[0])
        codes = _codes(words)
        prefix, second = _prefixes(codes, _BASE), _prefixes(codes, _SECOND)
        widths = range(1, min(v.longest, size) + 1)
        found = [self._found(prefix, second, width) for width in widths]
        found[0] = np.where(found[0] < 0, _FREE, found[0])

        total = np.full((n, size + 1), -np.inf)
        total[:, 0] = 0
        last = np.full((n, size + 1), -1, dtype=np.int64)
        back = np.zeros((n, size + 1), dtype=np.int32)
        for end in range(1, size + 1):
            widths = np.arange(1, min(v.longest, end) + 1)
            piece = np.stack([found[w - 1][:, end - w] for w in widths], axis=1)
            before = last[:, end - widths]
            ok = (piece != -1) & np.isfinite(total[:, end - widths])
            if end <= v.longest:  # the whole prefix as one piece
                whole = piece[:, end - 1]
                ok[:, end - 1] &= (whole == _FREE) | v.valid[np.maximum(whole, 0)]
            row, col = np.nonzero(ok & (piece >= 0) & (before >= 0) & (widths < end))
            ok[row, col] = self._allowed(before[row, col], piece[row, col])
            gain = np.where(piece >= 0, self.score[np.maximum(piece, 0)], 0.0)
            sums = np.where(ok, total[:, end - widths] + gain, -np.inf)
            best = sums.argmax(axis=1)
            each = np.arange(n)
            total[:, end], last[:, end] = sums[each, best], piece[each, best]
            back[:, end] = widths[best]
        if not np.isfinite(total[:, size]).all():
            raise ValueError("a word has no encoding")
        cut = np.zeros((n, size + 1), dtype=bool)
        row, end = np.arange(n), np.full(n, size)
        while len(row):
            cut[row, end] = True
            end = end - back[row, end]
            row, end = row[end > 0], end[end > 0]
        return last[cut], np.nonzero(cut)[1], cut.sum(axis=1)

    def _learn(self, words: Iterable[str]) -> None:
        """Encode distinct words, those of a length together."""
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for size, group in by_length.items():
            step = 1 if size > ALONE else TOGETHER
            for at in range(0, len(group), step):
                self._learn_together(group[at : at + step])

    def _learn_together(self, words: list[str]) -> None:
        v = self.vocabulary
        alone = len(words) == 1 and len(words[0]) > ALONE
        pieces, ends, counts = self._alone(words[0]) if alone else self._viterbi(words)
        stops = np.cumsum(counts)
        plain = (pieces >= 0) & (pieces < len(v.pieces) - len(v.loose))
        data = np.where(plain, pieces, 0).astype("<u4").tobytes()
        whole = np.logical_and.reduceat(plain, stops - counts).tolist()
        for word, stop, count, good in zip(words, stops.tolist(), counts.tolist(), whole):
            start = stop - count
            if good:
                self._words[word] = data[4 * start : 4 * stop]
                continue
            ids = []
            for i in range(start, stop):
                if plain[i]:
                    ids.append(pieces[i])
                else:
                    ids += [v.bytes[b] for b in word[ends[i] - 1].encode()]
            self._words[word] = np.array(ids, dtype="<u4").tobytes()

    def _cut(self, text: str) -> list[str]:
        """The words of a text, long ones in parts that no piece crosses."""
        words = WORD.findall(SPACE + text.replace(" ", SPACE)) if text else []
        if all(len(w) <= ALONE for w in words):
            return words
        out = []
        for w in words:
            if len(w) <= ALONE:
                out.append(w)
                continue
            codes = np.frombuffer(w.encode("utf-32-le"), "<u4").astype(np.int64)
            sides = (codes[:-1] << 32) | codes[1:]
            at = np.minimum(
                np.searchsorted(self.vocabulary.inside, sides), len(self.vocabulary.inside) - 1
            )
            cuts = np.flatnonzero(self.vocabulary.inside[at] != sides) + 1
            cuts = [0, *cuts.tolist(), len(w)]
            out += [w[a:b] for a, b in zip(cuts, cuts[1:])]
        return out

    def encode(self, documents: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = [self._cut(d) for d in documents]
        if self._held > REMEMBERED // 2:
            # Words that come again move on from the older half, the others go.
            self._older, self._words, self._held = self._words, {}, 0
        known, older = self._words, self._older
        missing = set().union(*cut).difference(known)
        again = missing.intersection(older)
        known.update((w, older[w]) for w in again)
        self._held += sum(map(len, missing))
        self._learn(missing - again)
        return [np.frombuffer(b"".join([known[w] for w in c]), "<u4") for c in cut]


def _prefixes(codes: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hashes of the first 0, 1, 2, ... characters of each row."""
    out = np.zeros((len(codes), codes.shape[1] + 1), dtype=np.uint64)
    for i in range(codes.shape[1]):
        out[:, i + 1] = out[:, i] * base + codes[:, i]
    return out


def _codes(words: list[str]) -> np.ndarray:
    """Code points plus one of words of one length, a row each."""
    flat = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    return flat.reshape(len(words), -1).astype(np.uint64) + np.uint64(1)


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        v = vocabulary
        table = [p.replace(SPACE, " ").encode() for p in v.pieces]
        for b, i in enumerate(v.bytes):
            table[i] = bytes([b])
        for i in v.special:
            table[i] = b" \xe2\x81\x87 " if v.pieces[i] == "<unk>" else b""
        self.table = table

    def decode(self, ids: Iterable[int]) -> str:
        table = self.table
        text = b"".join([table[i] for i in ids]).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


_made: dict[tuple, object] = {}


def _once(kind, path: str, vocabulary):
    """One encoder or decoder per Python worker, so that words stay known."""
    key = (kind, path)
    if key not in _made:
        _made[key] = kind(vocabulary.value)
    return _made[key]


_loaded: dict[str, Vocabulary] = {}


def _shared(df: DataFrame, path: str | None):
    path = path or public_tokenizers.path(MODEL)
    if path not in _loaded:
        _loaded[path] = Vocabulary.load(path)
    return path, df.sparkSession.sparkContext.broadcast(_loaded[path])


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id`` and ``ids``, little-endian unsigned 32-bit, of every text."""
    path, vocabulary = _shared(docs, model)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])

    def make():
        encoder = _once(Encoder, path, vocabulary)

        def apply(part):
            ids = [x.tobytes() for x in encoder.encode(texts(part))]
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(ids, pa.binary())], schema=schema
            )

        return apply

    source = docs.select(F.col("doc_id").cast("long"), "text")
    return map_slices(source, make, "doc_id long, ids binary", rows=TEXTS_TOGETHER)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """``doc_id``, ``ids`` and the ``text`` that they stand for."""
    path, vocabulary = _shared(encoded, model)
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])

    def make():
        decoder = _once(Decoder, path, vocabulary)

        def apply(part):
            found = [
                decoder.decode(np.frombuffer(x or b"", "<u4").tolist())
                for x in part.column("ids").to_pylist()
            ]
            return pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("ids"), pa.array(found, pa.string())],
                schema=schema,
            )

        return apply

    source = encoded.select("doc_id", "ids")
    return map_slices(source, make, "doc_id long, ids binary, text string", "ids")


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Number and checksum of the ids, length and hash of the decoded text."""
    return decode(encode(docs, model), model).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_ids"),
        F.crc32("ids").alias("ids_crc32"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"),
    )
