"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text is read left to right.  At each position the search keeps the best path that ends there: its
last piece and, for a unigram model, its score.  Unigram: the path with the greatest sum of piece
scores (a character without a piece costs the least score less 10).  Merge-based: a piece may follow another only if the merge
order of the model keeps the two apart (their joined text encodes to exactly these two pieces); this
leaves one path at every position, and the path at the end of the text is the encoding the
model defines, piece for piece.

Streaming: only the positions that a piece can still start from, those within the longest
piece's length, are alive.  Whenever the backpointer paths of all of them run through one
boundary, the ids before it are committed and everything before it is dropped, so the window is
bounded by the longest piece however long the text is.  Every text goes this way.  Where a space
follows another character no piece reaches across (in models without such pieces), so all paths meet there:
the stream commits, and the search starts afresh.  What it commits from one such place to the next depends on the
word between alone, so the ids of words are remembered, up to MEMORY_BYTES and for one task.

Characters outside the vocabulary become byte pieces, or one unknown id for each run of them.  Decoding joins pieces, turns byte pieces
back into UTF-8 and drops the prefix space, and so returns the text exactly, but for the escape
character U+2581 itself, which decodes to a space as the format has it.

Models with normalisation rules, user-defined pieces, or without the prefix space are refused.

Defined cases: a null text counts as empty and has no ids; an id that the model lacks, a control
id or the unknown id decodes to nothing; invalid byte runs decode to U+FFFD; repeated rows have
equal ids; only the id and text columns are read.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import CHUNK_BYTES, scored

SPACE = "▁"
#: Words up to this length are remembered, up to so many bytes of them; joined pairs of pieces that are remembered; steps.
WORD_CHARS, MEMORY_BYTES, PAIRS, STEPS = 32, 96 << 20, 1 << 17, 1 << 18
#: The score of a merge that there is not.
NONE = float("-inf")
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*")


def _fields(data: bytes):
    """(field, value) of a protocol-buffer message: whole numbers, or the bytes of nested fields and floats."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            size = number() if size is None else size
            yield key >> 3, data[at:at + size]
            at += size


def _described(model: bytes) -> bool:
    """Whether a model file holds a unigram model; raises for what the search can't encode."""
    # fixed values of the file format: pieces are field 1 (type 3), the trainer's settings 2 (model type 3), normalisation 3
    kind, rules = 1, {3: 1, 4: 1}
    for field, value in _fields(model):
        if field == 1 and dict(_fields(value)).get(3) == 4:
            raise ValueError("user-defined pieces are not supported")
        if field == 2:
            kind = dict(_fields(value)).get(3, 1)
        if field == 3:
            rules |= dict(_fields(value))
    if rules.get(2) or not rules[3] or rules[4]:
        raise ValueError("only models with identity normalisation, the prefix space and all white space kept are supported")
    if kind not in (1, 2):
        raise ValueError("only unigram and merge-based models are supported")
    return kind == 1


class Place(dict):
    """What the end of a text says of the pieces there: the longest beginning of a piece that the text ends in.

    By the next character it gives the place behind that; steps are worked out when first taken.
    """

    __slots__ = ("v", "text", "found")

    def __init__(self, v: Vocabulary, text: str):
        self.v, self.text = v, text
        #: (length, piece, its ids, what is known of the pieces before it) of the pieces that end here, the longest first
        ends = [text[k:] for k in range(len(text)) if text[k:] in v.whole]
        self.found = tuple((len(p), p, v.code[p], v.joined.setdefault(p, {})) for p in ends)

    def __missing__(self, char: str) -> Place:
        text = self.text + char
        while text and text not in self.v.prefixes:
            text = text[1:]
        return self.v.step(self, char, text)


class Vocabulary:
    """Pieces of a model file: ids, scores and what the search asks of them."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.unigram = _described(model.serialized_model_proto())
        n = model.get_piece_size()
        self.pieces = [model.id_to_piece(i) for i in range(n)]
        self.control = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.ids = {p: i for i, p in enumerate(self.pieces) if i not in self.control and i not in self.byte_of}
        self.score = {p: model.get_score(i) for p, i in self.ids.items()}
        self.unknown = model.unk_id()
        self.longest = max(map(len, self.ids), default=1)
        self.prefixes = {p[:k] for p in self.ids for k in range(1, len(p) + 1)}
        #: No piece holds a space after another character, so words can't share a piece.
        self.words_part = not any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.joined: dict[str, dict[str, bool]] = {}     # piece to whether it may stand behind another
        self.pairs = 0
        self.made: dict[str, list] = {}
        #: Pieces that the merges can make (others are never part of an encoding).
        self.whole = {p for p in self.ids if self.unigram or self.merges(p)[0] == [p]}
        self.unknown_score = min(self.score.values(), default=0.0) - 10.0
        self.code = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        self.places: dict[str, Place] = {}
        self.steps = 0
        self.spelling = [b"" if i in self.control else bytes([self.byte_of[i]]) if i in self.byte_of
                         else p.replace(SPACE, " ").encode() for i, p in enumerate(self.pieces)]

    def merges(self, text: str) -> tuple[list[str], list[tuple[str, str, float]]]:
        """Merge neighbours of a short text, best score first, leftmost first.

        Returns the parts at the end and, before each merge, the first part, the last part and the merge's score.
        """
        parts, score, steps = list(text), self.score.get, []
        scores = [score(x + y, NONE) for x, y in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > NONE:
            at = scores.index(best)
            steps.append((parts[0], parts[-1], best))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del scores[at]
            if at:
                scores[at - 1] = score(parts[at - 1] + parts[at], NONE)
            if at < len(scores):
                scores[at] = score(parts[at] + parts[at + 1], NONE)
        return parts, steps

    def history(self, piece: str) -> list[tuple[str, str, float]]:
        """The merges that make a piece, and the piece itself behind them."""
        if (known := self.made.get(piece)) is None:
            known = self.made[piece] = [*self.merges(piece)[1], (piece, piece, NONE)]
        return known

    def apart(self, a: str, b: str) -> bool:
        """Whether the merges of two pieces' joined text never cross the place between them.

        Until they do, each side merges as it does alone, so the two histories are run through side by side.
        """
        left, right, score = iter(self.history(a)), iter(self.history(b)), self.score.get
        (_, end, next_a), (start, _, next_b) = next(left), next(right)
        while True:
            across = score(end + start, NONE)
            if across > next_a and across >= next_b and across > NONE:      # of equal scores the leftmost merge is done first
                return False
            if next_a >= next_b and next_a > NONE:
                _, end, next_a = next(left)
            elif next_b > NONE:
                start, _, next_b = next(right)
            else:
                return True

    def outside(self, char: str) -> bytes:
        """Ids of a character that the vocabulary lacks."""
        ids = [self.bytes[b] for b in char.encode("utf-8", "replace")] if self.bytes else [self.unknown]
        return np.array(ids, "<u4").tobytes()

    def follows(self, a: str, b: str) -> bool:
        """Whether piece b may stand right after piece a."""
        if (known := self.joined.setdefault(b, {}).get(a)) is None:
            if self.pairs >= PAIRS:
                self.pairs = 0
                for before in self.joined.values():      # places hold these tables, so they stay
                    before.clear()
            self.pairs += 1
            known = self.joined[b][a] = self.apart(a, b)
        return known

    def place(self, text: str) -> Place:
        """The place behind a beginning of a piece."""
        if (found := self.places.get(text)) is None:
            found = self.places[text] = Place(self, text)
        return found

    def step(self, start: Place, char: str, text: str) -> Place:
        """Remember a step between places, up to STEPS of them."""
        if self.steps >= STEPS:
            self.steps = 0
            for place in self.places.values():           # a place that a stream stands at goes on from there
                place.clear()
            self.places.clear()
        self.steps += 1
        start[char] = found = self.place(text)
        return found


class Memory(dict):
    """Ids of words (without the space before them), all forgotten when they take more than MEMORY_BYTES."""

    size = 0

    def keep(self, word: str, ids: bytes) -> None:
        if len(word) <= WORD_CHARS:
            self.taken(200 + len(word) + len(ids))       # about what two short objects and their place in the table take
            self[word] = ids

    def taken(self, size: int) -> None:
        self.size += size
        if self.size > MEMORY_BYTES:
            self.clear()
            self.size = size


class StreamingViterbi:
    """Encoder of one text given in parts: ``feed`` returns the ids that are certain, ``end`` the rest.

    Texts come with SPACE for each space, ids as little-endian unsigned 32-bit bytes.
    """

    def __init__(self, vocabulary: Vocabulary, memory: Memory | None = None):
        self.v = vocabulary
        self.memory = Memory() if memory is None else memory
        self.held = ""                 # the word that the last part ended in
        self.commits = 0               # boundaries at which ids became certain
        self.most = 0                  # the longest window so far
        self._start()

    def _start(self) -> None:
        self.before = ""               # the piece that ends at the last committed boundary
        self.text = ""                 # the window: all characters after that boundary
        self.place = self.v.place("")  # the pieces at its end
        self.last: list[str] = [""]    # the piece that ends at each position of the window on its surviving path
        self.codes: list[bytes] = [b""]  # the ids of that piece
        self.best: list[float] = [0.0]   # the path's score from the boundary on (unigram)

    def ids(self, at: int) -> bytes:
        """The ids of the surviving path from the boundary to a position."""
        last, codes, out = self.last, self.codes, []
        while at:
            out.append(codes[at])
            at -= len(last[at])
        return b"".join(out[::-1])

    def advance(self) -> None:
        """Find the piece that ends at each position not yet reached."""
        if self.v.unigram:
            return self._advance_by_score()
        v, place, last, codes = self.v, self.place, self.last, self.codes
        known, follows = v.code, v.follows
        end = len(last)
        for char in self.text[end - 1:]:
            place = place[char]
            for size, piece, code, before in place.found:
                left = last[-size] if size < end else self.before
                fits = before.get(left)
                if fits if fits is not None else left not in known or follows(left, piece):
                    last.append(piece)
                    codes.append(code)
                    break
            else:
                self._outside(end)
            end += 1
        self.place = place

    def _outside(self, end: int) -> None:
        """The last character is in no piece that may stand here."""
        char, left = self.text[end - 1], self.last[end - 1] if end > 1 else self.before
        again = not self.v.bytes and left and left not in self.v.code      # a run of unknown characters has one id
        self.last.append(char)
        self.codes.append(b"" if again else self.v.outside(char))

    def _advance_by_score(self) -> None:
        v, text, place, last, codes, best = self.v, self.text, self.place, self.last, self.codes, self.best
        score = v.score
        for end in range(len(last), len(text) + 1):
            place = place[text[end - 1]]
            top = at = chosen = None
            for size, piece, code, _ in place.found:
                # of equal sums the longer last piece stands
                if top is None or best[end - size] + score[piece] > top:
                    top, at, chosen = best[end - size] + score[piece], piece, code
            if text[end - 1] not in score and (top is None or best[end - 1] + v.unknown_score > top):
                best.append(best[end - 1] + v.unknown_score)
                self._outside(end)
            else:
                best.append(top)
                last.append(at)
                codes.append(chosen)
        self.place = place

    def _commit(self) -> bytes:
        """Commit up to the last boundary that the paths of all alive positions share."""
        n = len(self.text)
        alive = [p for p in range(max(0, n - self.v.longest), n) if self.text[p:] in self.v.prefixes] + [n]
        shared = None
        for p in alive:
            bounds, at = {p}, p
            while at:
                at -= len(self.last[at])
                bounds.add(at)
            shared = bounds if shared is None else shared & bounds
        cut = max(shared)
        done = self.ids(cut)
        if cut:
            self.commits += 1
            self.before, self.text = self.last[cut], self.text[cut:]
            self.last = [""] + self.last[cut + 1:]
            self.codes = [b""] + self.codes[cut + 1:]
            self.best = [0.0] + [x - self.best[cut] for x in self.best[cut + 1:]] if self.v.unigram else self.best
        return done

    def _search(self, part: str) -> list[bytes]:
        """Move the window over a part of a text; what becomes certain on the way."""
        out, step = [], 2 * self.v.longest
        if not self.text and len(part) <= step:          # a short word: nothing can become certain on the way
            self.text = part
            self.advance()
            self.most = max(self.most, len(part))
            return out
        for at in range(0, len(part), step):
            self.text += part[at:at + step]
            self.advance()
            self.most = max(self.most, len(self.text))
            if len(self.text) > step:
                out.append(self._commit())
        return out

    def _word(self, word: str) -> bytes:
        """The ids of a word and the space before it: the paths meet before and behind both."""
        sure = self._search(SPACE + word)
        out = b"".join([*sure, self.ids(len(self.text))])
        self._start()
        self.memory.keep(word, out)
        return out

    def feed(self, part: str) -> bytes:
        if not self.v.words_part:
            return b"".join(self._search(part))
        if self.text:                                    # a long word is under way: up to where the next one begins
            cut = part.find(SPACE)
            if cut < 0:
                return b"".join(self._search(part))
            out = self._search(part[:cut])
            out.append(self.ids(len(self.text)))
            self.commits += 1
            self._start()
            return b"".join(out) + self.feed(part[cut:])
        text = self.held + part                          # begins with a space
        if SPACE + SPACE in text:
            words = [w[1:] for w in _WORDS.findall(text) if w]
        else:
            words = text[1:].split(SPACE)
        self.held = SPACE + words.pop()
        known = self.memory.get
        out = [known(w) or self._word(w) for w in words]
        self.commits += len(words)
        if len(self.held) > 4 * self.v.longest and self.held.strip(SPACE):
            out += self._search(self.held)               # a word so long that its own search commits
            self.held = ""
        return b"".join(out)

    def end(self) -> bytes:
        held, self.held = self.held, ""
        if self.text:
            out = b"".join(self._search(held)) + self.ids(len(self.text))
            self._start()
            return out
        return (self.memory.get(held[1:]) or self._word(held[1:])) if held else b""


class Codec:
    """Encode and decode whole texts; the ids of one text are little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        self.v = vocabulary(path)
        self.memory = Memory()
        sizes = [len(x) for x in self.v.spelling]
        self.sizes = np.array([*sizes, 0], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(self.v.spelling), np.uint8)

    def learn(self, texts: list) -> None:
        """Remember the words of some texts.

        In sorted order neighbours begin alike, and the state at the end of a shared beginning is
        the same, so the search of a word goes on from where it leaves the word before.
        """
        if not self.v.words_part:
            return
        memory = self.memory
        every = set().union(*[t.split(" ") for t in texts if t and SPACE not in t])
        new = sorted(w for w in every.difference(memory) if 0 < len(w) <= WORD_CHARS)
        memory.taken(400 * len(new))                     # a word and its ids, with room to spare
        stream = StreamingViterbi(self.v, memory)
        last, codes, best = stream.last, stream.codes, stream.best
        before = ""
        for word in new:
            shared = 0
            for a, b in zip(word, before):
                if a != b:
                    break
                shared += 1
            stream.text = SPACE + word
            del last[shared + 2:], codes[shared + 2:], best[shared + 2:]
            stream.place = self.v.place("")
            for char in stream.text[:len(last) - 1]:
                stream.place = stream.place[char]
            stream.advance()
            memory[word] = stream.ids(len(stream.text))
            before = word

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        stream = StreamingViterbi(self.v, self.memory)
        return stream.feed(SPACE + text.replace(" ", SPACE)) + stream.end()

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for, without the prefix space."""
        ids = np.where((ids >= 0) & (ids < len(self.sizes) - 1), ids, len(self.sizes) - 1)
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - self.starts[ids], sizes)
        out = self.data[at].tobytes()
        return out[1:] if out.startswith(b" ") else out

    def decode(self, ids: list[int]) -> str:
        return self.decode_bytes(np.array(ids, np.int64)).decode("utf-8", "replace")


def plain(text: str | None) -> str:
    """A text as decoding gives it back: null is empty, the escape character a space, what UTF-8 can't hold a question mark."""
    return (text or "").replace(SPACE, " ").encode("utf-8", "replace").decode("utf-8")


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """One vocabulary for each model and Python worker: its size is the model's."""
    return Vocabulary(path)


class _Task:
    """What one task works with: a codec whose words are gone when the task ends."""

    def __init__(self, path: str):
        self.path = path
        self.made: Codec | None = None

    def __getstate__(self):
        return {"path": self.path, "made": None}

    @property
    def codec(self) -> Codec:
        if self.made is None:
            self.made = Codec(self.path)
        return self.made


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           ids_col: str = "ids") -> DataFrame:
    """(id, ids array<int>) of every row."""
    task = _Task(model_path)

    def kernel(texts):
        c = task.codec
        return [[np.frombuffer(c.encode(t), "<u4").astype(np.int32) for t in texts]]

    return scored(docs, id_col, text_col, [(ids_col, pa.list_(pa.int32()))], kernel)


def decode(encoded: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids",
           text_col: str = "text") -> DataFrame:
    """(id, text) of every row of ids; null ids count as none."""
    source = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))

    def run(batches):
        c = Codec(model_path)
        for batch in batches:
            texts = [c.decode([x for x in (i or []) if x is not None]) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], ["id", "text"])

    from pyspark.sql.types import StringType, StructField, StructType
    schema = StructType([source.schema["id"], StructField("text", StringType())])
    return source.mapInArrow(run, schema).withColumnsRenamed({"id": id_col, "text": text_col})


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_crc32, same, ids, decoded) of every row: its ids, the text they decode to, the count and checksum
    of those ids, and whether that text is the row's own.

    Every text goes through the stream, which searches each word where it first meets it in a task.
    """
    task = _Task(model_path)

    def kernel(texts):
        c = task.codec
        codes = [c.encode(t) for t in texts]
        ids = [np.frombuffer(x, "<u4").astype(np.int32) for x in codes]
        decoded = [c.decode(i) for i in ids]
        same = [d == plain(t) for d, t in zip(decoded, texts)]
        return [[len(i) for i in ids], [zlib.crc32(x) for x in codes], same, ids, decoded]

    return scored(docs, id_col, text_col, [("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("same", pa.bool_()),
                                           ("ids", pa.list_(pa.int32())), ("decoded", pa.string())], kernel, CHUNK_BYTES)
