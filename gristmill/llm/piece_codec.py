"""Merge-type (BPE) SentencePiece encoding by a table of prefixes, and decoding.

Merging by score leaves a sequence of tokens exactly if it leaves each two neighbours of it: the first merge across a border
depends on the two tokens beside it alone. So every prefix of a text has one last token: the match ending there that is
compatible with the last token of the prefix before it. An automaton finds the matches, the test of two tokens replays their
own merges side by side, and the ids are read off backwards from the end. The work grows with the text, whatever it holds.

A text falls into units that no vocabulary piece crosses (a stretch of blanks with the word behind it, or one character that
occurs in no longer piece); a worker remembers the ids of units it has met.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.common import map_rows, prepare, table, worker_state

MODEL = "piece_bpe_32k.model"
#: Units and pairs of tokens that a worker remembers before it starts over; about 150 MB together.
REMEMBERED_UNITS = 500_000
REMEMBERED_PAIRS = 1_000_000
#: Longer units are not worth remembering.
REMEMBERED_LENGTH = 64
OWNER = "piece_codec"
_BLANK = "▁"
_NEVER = 1 << 60


def model_path(name: str = MODEL) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Pieces:
    """Vocabulary, merge order and compatibility of a merge-type model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.normalize = model.normalize
        if model.normalize("a  b ") != f"{_BLANK}a{_BLANK * 2}b{_BLANK}":
            raise ValueError(f"{path}: the model must put a blank before the text and keep all others")
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.bytes_of = {int(names[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        if len(self.bytes_of) != 256:
            raise ValueError(f"{path}: the model has no byte fallback")
        if any(model.is_unused(i) for i in range(size)):
            raise ValueError(f"{path}: unused pieces are not supported")
        silent = {i for i in range(size) if model.is_control(i) or model.is_unknown(i)}
        normal = {names[i]: i for i in range(size) if i not in silent and not model.is_byte(i)}
        self.begin, self.end = model.bos_id(), model.eos_id()
        # Equal scores are equal ranks: the place decides.
        order = {score: rank for rank, score in enumerate(sorted({model.get_score(i) for i in normal.values()}, reverse=True))}
        self._rank = {name: order[model.get_score(i)] for name, i in normal.items()}
        longer = {c for name in normal if len(name) > 1 for c in name}
        if any(_BLANK in name.lstrip(_BLANK) for name in normal):
            raise ValueError(f"{path}: pieces with a blank behind other characters are not supported")
        inner = "".join(re.escape(c) for c in sorted(longer - {_BLANK}))
        self.units = re.compile(f"{_BLANK}*[{inner}]+|{_BLANK}+|.", re.DOTALL).findall
        # Symbols are the pieces that merging their own characters gives, and the characters themselves.
        self._symbol = [name for name in sorted({*normal, *longer}) if self._derive(name) is not None]
        self._merges = [self._derive(name) for name in self._symbol]
        self._ids = [self._of_symbol(name, normal) for name in self._symbol]
        self._normal = normal
        self._automaton = ahocorasick.Automaton()
        for number, name in enumerate(self._symbol):
            self._automaton.add_word(name, (number, len(name)))
        self._automaton.make_automaton()
        self._pairs: dict[int, bool] = {}
        self._known: dict[str, bytes] = {}
        self._surface = [b"" if i in silent else names[i].replace(_BLANK, " ").encode() for i in range(size)]
        for value, i in self.bytes_of.items():
            self._surface[i] = bytes([value])
        self._byte_ids = np.zeros(size, bool)
        self._byte_ids[list(self.bytes_of.values())] = True
        self._unknown = model.unk_id()
        self._surface[self._unknown] = model.decode([self._unknown]).encode()

    def _of_symbol(self, name: str, normal: dict[str, int]) -> tuple[int, ...]:
        return (normal[name],) if name in normal else tuple(self.bytes_of[b] for b in name.encode())

    def _derive(self, name: str) -> list[tuple[int, str, str]] | None:
        """The merges that make a symbol of its characters, in order: rank, first and last part after it. None if they do not end in it."""
        parts, out = list(name), []
        while len(parts) > 1:
            rank, at = min((self._rank.get(a + b, _NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == _NEVER:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            out.append((rank, parts[0], parts[-1]))
        return out

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the characters of two symbols side by side leaves the two: no merge joins them first."""
        left, right = self._merges[a], self._merges[b]
        last, first = self._symbol[a][-1], self._symbol[b][0]
        i = j = 0
        while True:
            across = self._rank.get(last + first, _NEVER)
            next_left = left[i][0] if i < len(left) else _NEVER
            next_right = right[j][0] if j < len(right) else _NEVER
            # Of equal ranks the leftmost merge comes first.
            if across < next_left and across <= next_right and across != _NEVER:
                return False
            if next_left == next_right == _NEVER:
                return True
            if next_left <= next_right:
                last = left[i][2]
                i += 1
            else:
                first = right[j][1]
                j += 1

    def unit_ids(self, unit: str) -> bytes:
        """The ids of a unit as little-endian unsigned 32-bit numbers."""
        if len(unit) == 1:
            return np.array(self._of_symbol(unit, self._normal), np.uint32).tobytes()
        if len(self._pairs) > REMEMBERED_PAIRS:
            self._pairs.clear()
        pairs, compatible = self._pairs, self.compatible
        last, size = [-1] * (len(unit) + 1), len(self._symbol)
        for at, (token, length) in self._automaton.iter(unit):
            if last[at + 1] >= 0:
                continue
            start = at + 1 - length
            if start:
                key = last[start] * size + token
                fits = pairs.get(key)
                if fits is None:
                    fits = pairs[key] = compatible(last[start], token)
                if not fits:
                    continue
            last[at + 1] = token
        tokens, at = [], len(unit)
        while at:
            tokens.append(last[at])
            at -= len(self._symbol[last[at]])
        return np.array([i for token in reversed(tokens) for i in self._ids[token]], np.uint32).tobytes()

    def encode(self, text: str, ends: bool = True) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers, with begin and end ids if asked for."""
        units = self.units(self.normalize(text))
        known = self._known
        missing = set(units).difference(known)
        if len(known) + len(missing) > REMEMBERED_UNITS:
            known.clear()
            missing = set(units)
        # What is too long to remember, or too much, is known for this text only.
        passing = [u for u in missing if len(u) > REMEMBERED_LENGTH]
        for unit in missing:
            known[unit] = self.unit_ids(unit)
        body = b"".join(map(known.__getitem__, units))
        for unit in passing:
            del known[unit]
        if not ends:
            return body
        return np.uint32(self.begin).tobytes() + body + np.uint32(self.end).tobytes()

    def decode(self, ids: bytes) -> str:
        """The text of ids: the blank before it goes, runs of byte ids are read as UTF-8, each byte that is none is U+FFFD."""
        numbers = np.frombuffer(ids, np.uint32)
        if len(numbers) and int(numbers.max()) >= len(self._surface):
            raise ValueError("id out of range")
        parts = list(map(self._surface.__getitem__, numbers.tolist()))
        shown = next((i for i, part in enumerate(parts) if part), None)
        # The unknown id keeps its blank.
        if shown is not None and numbers[shown] != self._unknown and not self._byte_ids[numbers[shown]]:
            parts[shown] = parts[shown].removeprefix(b" ")
        if all(parts[1:-1]):
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        # A run of bytes ends at any other id, also at one without a text.
        return "".join(self._runs(numbers, parts))

    def _runs(self, numbers: np.ndarray, parts: list[bytes]) -> Iterator[str]:
        is_byte = self._byte_ids[numbers]
        borders = [0, *(np.flatnonzero(np.diff(is_byte)) + 1).tolist(), len(parts)]
        for a, b in zip(borders, borders[1:]):
            run = b"".join(parts[a:b])
            yield _lenient(run) if a < b and is_byte[a] else run.decode()


def _lenient(run: bytes) -> str:
    """Bytes as UTF-8, each byte that starts no character as U+FFFD."""
    out, at = [], 0
    while at < len(run):
        try:
            out.append(run[at:].decode())
            break
        except UnicodeDecodeError as bad:
            out.append(run[at : at + bad.start].decode() + "�")
            at += bad.start + 1
    return "".join(out)


def _shared(path: str) -> Pieces:
    state = worker_state(OWNER)
    if getattr(state, "path", None) != path:
        state.path, state.pieces = path, Pieces(path)
    return state.pieces


def encode(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None, decoded: bool = False) -> DataFrame:
    """(``id_column``, n_tokens, ids[, decoded]): each row's ids with begin and end, as little-endian unsigned 32-bit numbers.

    Null and empty texts are the begin and end ids alone. Rows with equal or null ids are separate. A text of any length is
    encoded whole. ``decoded`` adds the text that the ids decode to. Other columns are ignored; an empty table gives an
    empty result.
    """
    prepare(docs.sparkSession)
    model = path or model_path()

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        pieces = _shared(model)
        for row in rows:
            ids = pieces.encode(row["text"] or "")
            out = {"id": row["id"], "n_tokens": len(ids) // 4, "ids": ids}
            yield out | {"decoded": pieces.decode(ids)} if decoded else out

    narrow = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    found = map_rows(narrow, run, "id bigint, n_tokens bigint, ids binary" + ", decoded string" * decoded, OWNER)
    return found.withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, id_column: str = "doc_id", ids_column: str = "ids", path: str | None = None) -> DataFrame:
    """(``id_column``, text) of rows of ids as ``encode`` writes them; null ids are an empty text. An id outside the vocabulary is an error."""
    prepare(encoded.sparkSession)
    model = path or model_path()

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        pieces = _shared(model)
        for row in rows:
            yield {"id": row["id"], "text": pieces.decode(row["ids"] or b"")}

    narrow = encoded.select(F.col(id_column).cast("bigint").alias("id"), F.col(ids_column).alias("ids"))
    return map_rows(narrow, run, "id bigint, text string", OWNER).withColumnRenamed("id", id_column)


def op11_sentencepiece(spark, sf_dir: str) -> DataFrame:
    found = encode(table(spark, sf_dir, "documents"), decoded=True)
    return found.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
