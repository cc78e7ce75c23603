"""Text to piece ids and back, exactly as a merge-type sentencepiece model does it."""

import re
from functools import lru_cache, partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillworks.llm.arrowtext import carried_columns, slices

_MARK = "▁"
#: Stretches and pairs whose result a task remembers; then it starts again.
_REMEMBERED = 500_000
#: Types of pieces in a model file (fixed values of its format).
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_MERGE_TYPE = 2
#: What the library writes for the unknown piece.
_UNKNOWN_TEXT = " ⁇ "


class Pieces:
    """The pieces of a model: what they say, their scores, and which id each byte has."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        spec = model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if (
            model.trainer_spec.model_type != _MERGE_TYPE
            or spec.precompiled_charsmap
            or spec.remove_extra_whitespaces
            or not spec.escape_whitespaces
            or model.trainer_spec.treat_whitespace_as_suffix
            or kinds - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}
            or _BYTE not in kinds
        ):
            raise ValueError("only merge-type models with bytes for unknown characters and texts as they are")
        self.prefixed = spec.add_dummy_prefix
        self.kinds = [p.type for p in model.pieces]
        self.texts = [p.piece for p in model.pieces]
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for i, (kind, text) in enumerate(zip(self.kinds, self.texts)):
            if kind == _BYTE:
                self.byte_ids[int(text.strip("<>"), 16)] = i
        #: Normal pieces only: a text never holds the others.
        self.number = {t: i for i, (k, t) in enumerate(zip(self.kinds, self.texts)) if k == _NORMAL}
        self.score = {t: model.pieces[i].score for t, i in self.number.items()}
        #: What one piece leads to in the text of ids.
        self.surfaces = [
            bytes([int(t.strip("<>"), 16)])
            if k == _BYTE
            else {_CONTROL: b"", _UNKNOWN: _UNKNOWN_TEXT.encode()}.get(k, t.replace(_MARK, " ").encode())
            for k, t in zip(self.kinds, self.texts)
        ]


class Encoder:
    """Finds the one sequence of pieces that merging would give, without merging the text.

    Merging joins the neighbours with the best score, the leftmost at equal scores, until no
    neighbours make a piece. Its result is the only sequence of pieces of which every two
    neighbours stay as they are when the two alone are merged anew. So pieces are taken from the
    left, the longest that matches first (from an Aho-Corasick scan); a piece that does not go with
    the one before it gives way to its next shorter prefix, and where none is left, the place is
    marked as failed and the piece before it gives way. Only one sequence can lead to a place, so
    a failed place is never tried again.

    Nothing merges across two characters that stand side by side in no piece: behind a letter and
    before a comma, say, or around a character that is in no piece at all. So the text is cut at
    such places, and what is between is encoded once and remembered.
    """

    def __init__(self, pieces: Pieces):
        import ahocorasick

        self._pieces = pieces
        known = set().union(*pieces.number)
        # A character that is only part of longer pieces counts as a piece without an id.
        self._tokens = list(pieces.number) + sorted(known - pieces.number.keys())
        self._place = {t: i for i, t in enumerate(self._tokens)}
        self._sizes = [len(t) for t in self._tokens]
        self._automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, text in enumerate(self._tokens):
            self._automaton.add_word(text, i)
        self._automaton.make_automaton()
        self._shorter = [
            next((self._place[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self._place), -1)
            for t in self._tokens
        ]
        self._ids = [self._ids_of(t) for t in self._tokens]
        self._pairs, self._known = {}, {}
        self._beside = {t[k : k + 2] for t in self._tokens for k in range(len(t) - 1)}
        self._cut = self._cuts(known)

    def _cuts(self, known: set[str]):
        """A function that cuts a text where no piece goes on: at once where spaces stand only in
        front of pieces, line feeds alone, and no piece has letters beside other characters."""
        early = not any(b != _MARK * 2 and (b[1] == _MARK or "\n" in b) for b in self._beside)
        letter = re.compile(r"[^\W\d_]").match
        odd = "".join(sorted(c for c in known if letter(c) and not c.isalpha()))  # numerals, say
        mixed = any(a.isalpha() != b.isalpha() and a != _MARK for a, b in self._beside)
        if not early or mixed:
            return lambda text: [text]
        odd = re.escape(odd)
        other = rf"(?:[^\w{_MARK}\n]|[\d_{odd}])"
        return re.compile(rf"{_MARK}*(?:[^\W\d_{odd}]+|{other}+)|\n|{_MARK}+").findall

    def _ids_of(self, token: str) -> bytes:
        if token in self._pieces.number:
            return np.array([self._pieces.number[token]], dtype=np.int32).tobytes()
        return self._pieces.byte_ids[list(token.encode())].tobytes()

    def merged(self, text: str) -> list[str]:
        """Merge a short text in the plain way."""
        parts, score = list(text), self._pieces.score
        never = float("-inf")
        worth = [score.get(a + b, never) for a, b in zip(parts, parts[1:])]
        while worth:
            best = max(worth)
            if best == never:
                break
            at = worth.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del worth[at]
            if at:
                worth[at - 1] = score.get(parts[at - 1] + parts[at], never)
            if at < len(worth):
                worth[at] = score.get(parts[at] + parts[at + 1], never)
        return parts

    def _compatible(self, left: int, right: int) -> bool:
        key = left * len(self._tokens) + right
        found = self._pairs.get(key)
        if found is None:
            two = [self._tokens[left]] if left >= 0 else []
            two.append(self._tokens[right])
            if len(self._pairs) >= _REMEMBERED:
                self._pairs.clear()
            found = self._pairs[key] = self.merged("".join(two)) == two
        return found

    def tokens(self, text: str) -> list[int] | None:
        """The tokens of a stretch; None if some character of it is in no piece."""
        n, sizes, shorter = len(text), self._sizes, self._shorter
        pairs, all_tokens = self._pairs, len(self._tokens)
        longest = [-1] * n
        for end, token in self._automaton.iter(text):
            longest[end + 1 - sizes[token]] = token  # later matches from one place are longer
        if -1 in longest:
            return None
        failed = bytearray(n + 1)
        taken, at, last, token = [], 0, -1, longest[0]
        while True:
            while token >= 0:
                end = at + sizes[token]
                if not failed[end]:
                    fits = pairs.get(last * all_tokens + token)
                    if fits or (fits is None and self._compatible(last, token)):
                        break
                token = shorter[token]
            if token >= 0:
                if end == n:
                    taken.append(token)
                    return taken
                taken.append(token)
                at, last, token = end, token, longest[end]
            else:
                failed[at] = 1
                token = taken.pop()
                at -= sizes[token]
                last = taken[-1] if taken else -1

    def _encode_part(self, text: str) -> bytes:
        tokens = self.tokens(text)
        if tokens is not None:
            return b"".join([self._ids[t] for t in tokens])
        if len(text) == 1:
            return self._pieces.byte_ids[list(text.encode())].tobytes()
        return self._encode_parts(self._apart(text))

    def _apart(self, text: str) -> list[str]:
        """Cut a stretch between all characters that stand side by side in no piece."""
        cuts = [k for k in range(1, len(text)) if text[k - 1 : k + 1] not in self._beside]
        return [text[a:b] for a, b in zip([0] + cuts, cuts + [len(text)])]

    def _encode_parts(self, parts: list[str]) -> bytes:
        out = list(map(self._known.get, parts))
        if None in out:
            for k in [k for k, ids in enumerate(out) if ids is None]:
                # An earlier one of these may have been the same part.
                out[k] = self._known.get(parts[k]) or self._remember(parts[k], self._encode_part(parts[k]))
        return b"".join(out)

    def _remember(self, text: str, ids: bytes) -> bytes:
        if len(text) < 100:
            if len(self._known) >= _REMEMBERED:
                self._known.clear()
            self._known[text] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids of a text, 4 bytes each."""
        if not text:
            return b""
        text = text.replace(" ", _MARK)
        if self._pieces.prefixed:
            text = _MARK + text
        return self._encode_parts(self._cut(text))


class Decoder:
    """Joins what pieces say; the space that encoding put in front is taken off again."""

    def __init__(self, pieces: Pieces):
        self._surfaces = pieces.surfaces
        self._kinds, self._texts = pieces.kinds, pieces.texts
        self._prefixed = pieces.prefixed
        self._control = {i for i, kind in enumerate(pieces.kinds) if kind == _CONTROL}

    def decode(self, ids: list[int]) -> str:
        if ids and (min(ids) < 0 or max(ids) >= len(self._surfaces)):
            raise ValueError("an id outside the vocabulary")
        if not self._control.isdisjoint(ids):
            # A control piece says nothing, but bytes on both sides of it do not go together.
            parts = [list(run) for control, run in groupby(ids, self._control.__contains__) if not control]
        else:
            parts = [ids] if ids else []
        return "".join([self._joined(part, k == 0) for k, part in enumerate(parts)])

    def _joined(self, ids: list[int], front: bool) -> str:
        joined = b"".join(map(self._surfaces.__getitem__, ids))
        if front and self._prefixed and self._kinds[ids[0]] == _NORMAL:
            joined = joined[self._texts[ids[0]].startswith(_MARK) :]
        try:
            return joined.decode()
        except UnicodeDecodeError:
            return _with_replacements(joined)


def _with_replacements(data: bytes) -> str:
    """UTF-8 in which each byte that starts no character becomes one replacement character."""
    out, at = [], 0
    while at < len(data):
        try:
            out.append(data[at:].decode())
            break
        except UnicodeDecodeError as error:
            out.append(data[at : at + error.start].decode())
            out.append("�")
            at += error.start + 1
    return "".join(out)


@lru_cache(1)
def _loaded(path: str) -> Pieces:
    return Pieces(path)


def _encode(batches, path):
    encoder = Encoder(_loaded(path))
    for batch in batches:
        for part in slices(batch, "text"):
            coded = [encoder.encode(t) if t else b"" for t in part.column(0).to_pylist()]
            ends = np.cumsum([0] + [len(c) // 4 for c in coded])
            ids = pa.array(np.frombuffer(b"".join(coded), dtype=np.int32))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
            yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), lists], names=["doc_id", "carried", "ids"])


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", carry=()) -> DataFrame:
    """``doc_id, carried, ids``: each text's piece ids, without begin or end.

    ``model_path`` names a merge-type (BPE) sentencepiece model that leaves texts as they are and
    has bytes for unknown characters, at the same place on every executor; others raise an error.
    ``carry`` names columns that go along in the struct ``carried``. A task works on about 4 MB of
    text, or one text, at a time, and a stretch without a break costs time and memory in proportion
    to its length.

    Null and empty texts have no ids; a null id stays; repeated rows are encoded each; an empty
    table gives an empty table; other columns are ignored. Strings of control pieces within a text
    are text.
    """
    rows = docs.select(
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        carried_columns(carry),
    )
    kind = rows.schema["carried"].dataType.simpleString()
    return rows.mapInArrow(partial(_encode, path=model_path), f"doc_id bigint, carried {kind}, ids array<int>")


def _decode(batches, path):
    decoder = Decoder(_loaded(path))
    for batch in batches:
        for low in range(0, batch.num_rows, 256):
            part = batch.slice(low, 256)
            texts = [None if ids is None else decoder.decode(ids) for ids in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(1), part.column(2), pa.array(texts, pa.string())], names=["doc_id", "carried", "text"]
            )


def decode(coded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids", carry=()) -> DataFrame:
    """``doc_id, carried, text``: the text that the ids stand for.

    Control pieces say nothing, bytes that make no character give replacement characters, and the
    space in front that encoding adds is taken off. A null list gives a null text, an empty one an
    empty text; an id outside the vocabulary, or a null in a list, raises an error. Other columns
    are ignored but for those in ``carry``, which go along in the struct ``carried``.
    """
    rows = coded.select(
        F.col(f"`{ids_col}`").cast("array<int>").alias("ids"),
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        carried_columns(carry),
    )
    kind = rows.schema["carried"].dataType.simpleString()
    return rows.mapInArrow(partial(_decode, path=model_path), f"doc_id bigint, carried {kind}, text string")
