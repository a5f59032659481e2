"""SentencePiece BPE with seeded merge-dropout, and lossless decoding.

The model file gives pieces with scores. A text is written with U+2581 for
spaces (one in front) and cut where no piece of the model can reach across -
before every run of spaces and between groups of characters that no piece
holds side by side - so each chunk is merged by itself. Merging follows the
agenda: of the adjacent pairs that form a piece the one with the best score is
taken next (leftmost of equals). With dropout every candidate taken from the
agenda is first drawn on: with the rate's chance it is skipped for good, and the
pair only comes back if one of its sides is merged anew. Rate 0 is the model's
own encoding.

Each occurrence of a chunk in a document draws its own skips from a hash of
(seed, document key, place in the document), so no two occurrences of a word
need be cut alike; the result depends on nothing but seed, key and text. Which
candidates are skipped is drawn as gaps between them (geometric, the same as one
draw a candidate). An outcome depends on the chunk and the numbers of the
skipped candidates alone, so outcomes are remembered per task by these in a
bounded table, as a tree: an occurrence goes from the outcome without a skip to
that with its first skip, and on, until its next skip lies behind the last
candidate. The new outcomes of some hundred texts are merged together, one
agenda step of all of them at a time, with arrays. Chunks of more than 48
letters are merged for each occurrence, with a keyed hash of the candidate.

Characters outside the vocabulary become byte pieces, and so does a literal
U+2581, which the plain model would turn into a space; so decoding gives back
every text exactly.
"""

from __future__ import annotations

import functools
import heapq
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensia.llm.common import fill, ship

SPACE = "▁"
NORMAL, USER = 1, 4  # piece types that take part in merging
BYTE = 6
MASK = (1 << 64) - 1
NEVER = 1 << 30  # rank of a pair that is no piece or was skipped
REMEMBERED = 1 << 19  # outcomes kept per task before it starts afresh
SHORT = 48  # letters; outcomes of longer chunks are not remembered
TEXTS = 1024  # texts whose chunks are merged together
CHARACTERS = 4 << 20  # and their characters at most, but for one text alone


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Model:
    """Pieces and merge order of a BPE model file with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec, norm = proto.trainer_spec, proto.normalizer_spec
        if spec.model_type != 2 or not spec.byte_fallback or norm.precompiled_charsmap or norm.remove_extra_whitespaces:
            raise ValueError("a BPE model with byte fallback and without normalisation is needed")
        self.prefix = SPACE if norm.add_dummy_prefix else ""
        merging = [(i, p.piece, p.score) for i, p in enumerate(proto.pieces) if p.type in (NORMAL, USER)]
        if any(re.search(f"[^{SPACE}]{SPACE}", piece) for _, piece, _ in merging):
            raise ValueError("pieces reach across spaces")
        self.ids = {piece: i for i, piece, _ in merging}
        order = sorted(merging, key=lambda m: -m[2])
        ranks, last = {}, None
        for _, piece, score in order:  # equal scores share a rank; then the leftmost wins
            last = (score, 0) if last is None else (score, last[1] + (score != last[0]))
            ranks[piece] = last[1]
        self.ranks = ranks
        self.pairs = PairTable(self.ids, ranks)
        self.chunks = _chunk_pattern(self.ids)
        self.bytes = [0] * 256
        self.literal = ()
        self.text: list[bytes] = [b""] * len(proto.pieces)
        for i, p in enumerate(proto.pieces):
            if p.type == BYTE:
                value = int(p.piece[3:5], 16)
                self.bytes[value] = i
                self.text[i] = bytes([value])
            elif p.type in (NORMAL, USER):
                self.text[i] = p.piece.replace(SPACE, " ").encode()
        self.literal = tuple(self.bytes[b] for b in SPACE.encode())

    def merge(self, chunk: str, threshold: int, key: int) -> list[str]:
        """The chunk's pieces; a candidate whose keyed hash is below ``threshold`` is skipped."""
        return _merge_short(chunk, self.ranks, threshold, key) if len(chunk) <= SHORT else _merge_long(chunk, self.ranks, threshold, key)

    def chunk_ids(self, chunk: str, threshold: int, key: int) -> tuple[int, ...]:
        out: list[int] = []
        for piece in self.merge(chunk, threshold, key):
            if (i := self.ids.get(piece)) is not None:
                out.append(i)
            else:
                out.extend(self.bytes[b] for b in piece.encode())
        return tuple(out)

    def expand(self, symbols: list[int]) -> tuple[int, ...]:
        """Ids of merged symbols; characters without a piece as bytes."""
        out: list[int] = []
        for i in symbols:
            if i < LETTER:
                out.append(i)
            else:
                out.extend(self.bytes[b] for b in chr(i - LETTER).encode())
        return tuple(out)

    def decode(self, ids) -> str:
        raw = b"".join(map(self.text.__getitem__, ids))
        return (raw[1:] if self.prefix and raw[:1] == b" " else raw).decode("utf-8")


LITERAL = SPACE + "\0literal"  # stands for a literal U+2581; compared by identity
LETTER = 1 << 24  # a character without a piece is this plus its code point


def _chunk_pattern(ids: dict[str, int]) -> re.Pattern:
    """Cuts a text where no piece reaches across.

    ASCII characters that no chain of pieces joins to the letter ``a``, and
    what is joined to them, are cut off from all others; spaces stay with
    what follows them.
    """
    parent: dict[str, str] = {}

    def find(c: str) -> str:
        while parent.setdefault(c, c) != c:
            c = parent[c]
        return c

    for piece in ids:
        for a, b in zip(piece, piece[1:]):
            if a != SPACE:
                parent[find(a)] = find(b)
    apart = {find(c) for c in map(chr, range(128)) if c != SPACE and find(c) != find("a")}
    alone = "".join(re.escape(c) for c in sorted(parent) if c != SPACE and find(c) in apart)
    return re.compile(f"{SPACE}*[{alone}]+|{SPACE}*[^{SPACE}{alone}]+|{SPACE}+")


class PairTable:
    """(left piece, right piece) -> (rank, merged piece) as a hash table of arrays."""

    def __init__(self, ids: dict[str, int], ranks: dict[str, int]):
        pairs = [(ids[p[:i]] << 25 | ids[p[i:]], ranks[p], n) for p, n in ids.items() for i in range(1, len(p)) if p[:i] in ids and p[i:] in ids]
        self.shift = np.uint64(64 - (4 * len(pairs)).bit_length())
        size = 1 << (4 * len(pairs)).bit_length()
        self.codes = np.full(size + 64, -1, np.int64)
        self.rank = np.full(size + 64, NEVER, np.int32)
        self.merged = np.zeros(size + 64, np.int32)
        spots = self._spot(np.array([c for c, _, _ in pairs], np.int64)).tolist()
        for (code, rank, piece), at in zip(pairs, spots):
            steps = 0
            while self.codes[at + steps] >= 0:
                steps += 1
            self.codes[at + steps], self.rank[at + steps], self.merged[at + steps] = code, rank, piece

    def _spot(self, code: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((code.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank or NEVER, merged piece) of each pair."""
        code = (left.astype(np.int64) << 25) | right
        at = self._spot(code)
        rank, merged = np.full(code.shape, NEVER, np.int32), np.zeros(code.shape, np.int32)
        look = np.arange(len(code))
        while look.size:  # until each pair or an empty place is found
            there = self.codes[at]
            hit = there == code[look]
            rank[look[hit]], merged[look[hit]] = self.rank[at[hit]], self.merged[at[hit]]
            on = ~hit & (there >= 0)
            look, at = look[on], at[on] + 1
        return rank, merged


def _merge_many(chunks: list[str], letters: dict[str, int], pairs: PairTable, skips: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, how many, candidates taken) of chunks of up to SHORT letters each, all merged
    step by step together; ``skips``: the numbers of each chunk's skipped candidates, filled up with -1."""
    n, width = len(chunks), max(map(len, chunks))
    lengths = np.fromiter(map(len, chunks), np.int64, n)
    symbols = np.zeros((n, width + 1), np.int32)
    inside = np.arange(width + 1) < lengths[:, None]
    flat = "".join(chunks)
    codes = np.frombuffer(flat.encode("utf-32-le"), np.uint32)
    unique, inverse = np.unique(codes, return_inverse=True)
    symbols[inside] = np.array([letters.get(chr(c), LETTER + c) for c in unique.tolist()], np.int32)[inverse]
    rank, merged = np.full((n, width), NEVER, np.int32), np.zeros((n, width), np.int32)
    both = inside[:, 1:]
    rank[both], merged[both] = pairs.find(symbols[:, :-1][both], symbols[:, 1:][both])
    out_symbols, out_lengths, taken = symbols, lengths, np.zeros(n, np.int64)
    active = np.arange(n)
    columns = np.arange(width + 1)
    for step in itertools.count():
        at = rank.argmin(axis=1)
        rows = np.arange(len(active))
        best = rank[rows, at]
        live = best < NEVER
        if not live.all():  # finished chunks leave the arrays
            if out_symbols is not symbols:
                gone = active[~live]
                out_symbols[gone, : symbols.shape[1]] = symbols[~live]
                out_lengths[gone] = lengths[~live]
            else:
                out_symbols, out_lengths = symbols.copy(), lengths.copy()
            taken[active[~live]] = step
            active, symbols, lengths, rank, merged, skips = (a[live] for a in (active, symbols, lengths, rank, merged, skips))
            at = at[live]
            rows = np.arange(len(active))
            if not len(active):
                break
        if skips.shape[1]:
            skip = (skips == step).any(axis=1)
            rank[rows[skip], at[skip]] = NEVER
            rows, at = rows[~skip], at[~skip]
            if not len(rows):
                continue
        symbols[rows, at] = merged[rows, at]
        everyone = len(rows) == len(active)
        moved = (columns[None, :] + (columns[None, :] > at[:, None])).clip(max=width)
        symbols[rows] = np.take_along_axis(symbols if everyone else symbols[rows], moved, axis=1)
        between = (columns[None, :width] + (columns[None, :width] >= at[:, None])).clip(max=width - 1)
        for a in (rank, merged):
            a[rows] = np.take_along_axis(a if everyone else a[rows], between, axis=1)
        lengths[rows] -= 1
        rank[rows] = np.where(columns[None, :width] < lengths[rows][:, None] - 1, rank[rows], NEVER)
        for side, ok in ((at, at < lengths[rows] - 1), (at - 1, at > 0)):
            r, c = rows[ok], side[ok]
            rank[r, c], merged[r, c] = pairs.find(symbols[r, c], symbols[r, c + 1])
    return out_symbols, out_lengths, taken


@functools.lru_cache(maxsize=2)
def model(path: str) -> Model:
    return Model(path)


def _skipped(rank: int, at: int, key: int, threshold: int) -> bool:
    """Keyed hash of a candidate (its piece by rank, the place of its first character)."""
    x = (key ^ (rank * 0x9E3779B97F4A7C15) ^ (at * 0xC2B2AE3D27D4EB4F)) & MASK
    x = ((x ^ (x >> 32)) * 0xD6E8FEB86659FD93) & MASK
    return (x >> 32) ^ (x & 0xFFFFFFFF) < threshold


def _merge_short(chunk: str, ranks: dict[str, int], threshold: int, key: int) -> list[str]:
    """Agenda as a list: the candidates' ranks beside the symbols."""
    symbols, get = list(chunk), ranks.get
    if len(symbols) == 1:
        return symbols
    starts = list(range(len(symbols)))
    agenda = [get(a + b, NEVER) for a, b in zip(symbols, symbols[1:])]
    while (best := min(agenda)) != NEVER:
        i = agenda.index(best)
        if threshold and _skipped(best, starts[i], key, threshold):
            agenda[i] = NEVER
            continue
        symbols[i] += symbols.pop(i + 1)
        del agenda[i], starts[i + 1]
        if not agenda:
            break
        if i < len(agenda):
            agenda[i] = get(symbols[i] + symbols[i + 1], NEVER)
        if i:
            agenda[i - 1] = get(symbols[i - 1] + symbols[i], NEVER)
    return symbols


def _merge_long(chunk: str, ranks: dict[str, int], threshold: int, key: int) -> list[str]:
    """The same with a heap and linked symbols, for chunks of any length."""
    n, get = len(chunk), ranks.get
    symbols: list[str] = list(chunk)
    before, after = list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[int, int, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and (j := after[i]) >= 0 and (rank := get(piece := symbols[i] + symbols[j])) is not None:
            heapq.heappush(heap, (rank, i, len(symbols[i]), piece))

    for i in range(n - 1):
        offer(i)
    while heap:
        rank, i, left, piece = heapq.heappop(heap)
        j = after[i]
        if j < 0 or len(symbols[i]) != left or symbols[i] + symbols[j] != piece:
            continue  # one of its sides has changed
        if threshold and _skipped(rank, i, key, threshold):
            continue
        symbols[i], symbols[j] = piece, ""
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [s for s in symbols if s]


class Numbers(dict):
    """Chunk -> its number; a new chunk gets the next one."""

    def __init__(self, names: list[str]):
        super().__init__()
        self.names = names

    def __missing__(self, chunk: str) -> int:
        self[chunk] = n = len(self.names)
        self.names.append(chunk)
        return n


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Encoder:
    """Encodes texts; outcomes once merged are kept as ids in one long array.

    An outcome is a chunk with the numbers of its skipped candidates; its place
    in ``start`` and ``length`` points into ``ids``, ``taken`` has the number of
    candidates. ``variants`` above 0: so many different draws for all
    occurrences of a chunk; 0: each occurrence has its own.
    """

    def __init__(self, path: str, dropout: float, seed: int, variants: int = 0):
        self.model, self.seed, self.dropout = model(path), seed, dropout
        self.threshold = int(dropout * (1 << 32))
        self.variants = variants
        self._forget()

    def _forget(self) -> None:
        self.names: list[str] = []
        self.number = Numbers(self.names)
        self.outcomes = 0
        self.root = np.zeros(0, np.int64)  # chunk -> its outcome without a skip
        self.chunk, self.parent, self.skip = np.zeros((3, 0), np.int32)  # of an outcome; what its last skip came after
        self.steps, self.after = np.zeros((2, 0), np.int64)  # outcome << 32 | next skip, sorted -> outcome
        self.start, self.length, self.taken = np.zeros(0, np.int64), np.full(0, -1, np.int32), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def _cut(self, text: str) -> list[str]:
        """Chunks; a literal U+2581 is a chunk of two (no text gives that one otherwise)."""
        if not text:
            return []
        prefix, cut = self.model.prefix, self.model.chunks.findall
        if SPACE not in text:
            return cut(prefix + text.replace(" ", SPACE))
        chunks: list[str] = []
        for n, part in enumerate(text.split(SPACE)):
            if n:
                chunks.append(LITERAL)
            chunks += cut((prefix if n == 0 else "") + part.replace(" ", SPACE))
        return chunks

    def _draws(self, n: int, key: object) -> np.ndarray:
        """A random number for each occurrence of a document."""
        base = xxhash.xxh3_64_intdigest(f"{self.seed}|{key}")
        with np.errstate(over="ignore"):
            x = _mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(base))
            if self.variants:
                x = _mixed(x % np.uint64(self.variants) + np.uint64(xxhash.xxh3_64_intdigest(f"{self.seed}")))
        return x

    def _gaps(self, draws: np.ndarray, turn: int) -> np.ndarray:
        """Candidates merged before the next skip."""
        with np.errstate(over="ignore"):
            u = (_mixed(draws + np.uint64((turn + 1) * 0xC2B2AE3D27D4EB4F & MASK)) >> np.uint64(11)) * 2.0**-53
        with np.errstate(divide="ignore"):
            return np.minimum(np.log1p(-u) / np.log1p(-self.dropout), NEVER).astype(np.int64)

    def _add(self, chunk: np.ndarray, parent: np.ndarray | int, skip: np.ndarray | int) -> np.ndarray:
        """New outcomes, not merged yet."""
        new = np.arange(self.outcomes, self.outcomes + len(chunk))
        self.outcomes += len(chunk)
        if self.outcomes > len(self.length):
            more = max(self.outcomes, len(self.length) * 5 // 4) - len(self.length)
            for name in ("chunk", "parent", "skip", "start", "length", "taken"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.full(more, -1, old.dtype)]))
        self.chunk[new], self.parent[new], self.skip[new] = chunk, parent, skip
        return new

    def _keep(self, where: np.ndarray, counts: np.ndarray, ids: np.ndarray, taken: np.ndarray | int) -> None:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + len(ids), np.int32)])
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[where] = self.used + np.cumsum(counts) - counts
        self.length[where], self.taken[where] = counts, taken
        self.used += len(ids)

    def _learn(self, places: np.ndarray) -> None:
        """Merge the outcomes (of chunks of up to SHORT letters) at these places."""
        m, names = self.model, [self.names[i] for i in self.chunk[places].tolist()]
        order = np.argsort(np.fromiter(map(len, names), np.int64, len(names)), kind="stable")
        for low in range(0, len(order), 8192):
            part = order[low : low + 8192]
            chunks, skips, up = [names[i] for i in part.tolist()], [], places[part]
            while (own := np.where(up >= 0, self.skip[up], -1)).max() >= 0:
                skips.append(own)
                up = np.where(up >= 0, self.parent[up], -1)
            skips = np.stack(skips, axis=1) if skips else np.zeros((len(part), 0), np.int32)
            symbols, counts, taken = _merge_many(chunks, m.ids, m.pairs, skips)
            used = np.arange(symbols.shape[1]) < counts[:, None]
            plain = ~((symbols >= LETTER) & used).any(axis=1)
            self._keep(places[part[plain]], counts[plain], symbols[plain][used[plain]], taken[plain])
            for i in np.flatnonzero(~plain).tolist():
                literal = chunks[i] is LITERAL
                ids = m.literal if literal else m.expand(symbols[i, : counts[i]].tolist())
                self._keep(places[part[i : i + 1]], np.array([len(ids)]), np.array(ids), 0 if literal else taken[i])

    def _skip(self, place: np.ndarray, draws: np.ndarray) -> np.ndarray:
        """The outcomes that the occurrences' skips lead to, from those without a skip."""
        place = place.copy()
        active, at = np.arange(len(place)), np.full(len(place), -1, np.int64)
        for turn in itertools.count():
            here = np.unique(place[active])
            if (new := here[self.length[here] < 0]).size:
                self._learn(new)
            if not self.threshold:
                return place
            at = at + 1 + self._gaps(draws[active], turn)
            on = at < self.taken[place[active]]
            active, at = active[on], at[on]
            if not active.size:
                return place
            steps, inverse = np.unique(place[active] << 32 | at, return_inverse=True)
            spot = np.searchsorted(self.steps, steps)
            new = np.append(self.steps, -1)[spot] != steps
            if new.any():
                parent = steps[new] >> 32
                made = self._add(self.chunk[parent], parent, steps[new] & 0xFFFFFFFF)
                self.steps, self.after = np.insert(self.steps, spot[new], steps[new]), np.insert(self.after, spot[new], made)
            place[active] = self.after[np.searchsorted(self.steps, steps)][inverse]

    def encode_many(self, texts: list[str], keys: list) -> list[np.ndarray]:
        if self.outcomes > REMEMBERED:
            self._forget()
        number, places, draws, counts, long = self.number, [], [], [], []
        done = 0
        for text, key in zip(texts, keys):
            chunks = self._cut(text)
            own = self._draws(len(chunks), key)
            if len(text) >= SHORT:
                for i, chunk in enumerate(chunks):
                    if len(chunk) > SHORT:  # merged for this occurrence alone
                        long.append((done + i, self.model.chunk_ids(chunk, self.threshold, int(own[i]))))
                        chunks[i] = ""
            places.append(np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks)))
            draws.append(own)
            counts.append(len(chunks))
            done += len(chunks)
        self.root = np.append(self.root, self._add(np.arange(len(self.root), len(self.names)), -1, -1))
        place = self.root[np.concatenate(places)] if places else np.zeros(0, np.int64)
        apart = np.array([i for i, _ in long], np.int64)
        short = np.ones(len(place), bool)
        short[apart] = False
        if short.any():
            place[short] = self._skip(place[short], np.concatenate(draws)[short])
        start, lengths, ids = self.start[place], self.length[place].astype(np.int64), self.ids
        if long:
            lengths[apart] = [len(x) for _, x in long]
            start[apart] = self.used + np.cumsum(lengths[apart]) - lengths[apart]
            ids = np.concatenate([ids[: self.used], *(np.array(x, np.int32) for _, x in long)])
        ends = np.cumsum(lengths)
        spots = np.repeat(start - (ends - lengths), lengths) + np.arange(int(ends[-1]) if ends.size else 0)
        cuts = np.append(0, ends)[np.cumsum(counts)] if counts else []
        return np.split(ids[spots], cuts)[:-1]

    def encode(self, text: str, key: object = None) -> list[int]:
        return self.encode_many([text], [key])[0].tolist()


def stretches(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Cuts of a column into at most ``TEXTS`` texts and ``CHARACTERS`` characters
    (a longer text is alone)."""
    sizes = np.append(0, np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)))
    low = 0
    while low < len(texts):
        high = int(np.searchsorted(sizes, sizes[low] + CHARACTERS, "right")) - 1
        high = min(max(high, low + 1), low + TEXTS, len(texts))
        yield low, high
        low = high


def encode_documents(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", dropout: float = 0.1, seed: int = 0, variants: int = 0,
    model_path: str | None = None,
) -> DataFrame:
    """key and ``pieces`` (array of ids) per row.

    Null text: null pieces. Empty text: no pieces. Null, tied or repeated
    keys: rows with equal key and text are cut alike. Empty table: no rows.
    Extra columns are not read. A chunk without spaces may be very long (its
    merging is n log n).
    """
    ship(docs.sparkSession)
    path, kind = model_path or default_path(), docs.schema[key].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("key", to_arrow_type(kind)), ("pieces", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, dropout, seed, variants)
        for batch in batches:
            for low, high in stretches(batch.column(1)):
                part = batch.slice(low, high - low)
                texts = part.column(1).to_pylist()
                made = encoder.encode_many([t or "" for t in texts], part.column(0).to_pylist())
                pieces = [None if t is None else ids for t, ids in zip(texts, made)]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(schema[0].type), pa.array(pieces, schema[1].type)], schema=schema)

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind.simpleString()}, pieces array<int>").withColumnRenamed("key", key)


def decode_documents(coded: DataFrame, *, pieces: str = "pieces", text: str = "text", model_path: str | None = None) -> DataFrame:
    """``coded`` with the texts that its pieces stand for (null pieces: null)."""
    ship(coded.sparkSession)
    path = model_path or default_path()

    @F.pandas_udf("string")
    def decoded(column):
        import pandas as pd

        m = model(path)
        return pd.Series([None if ids is None else m.decode(ids.tolist()) for ids in column], dtype=object)

    return coded.withColumn(text, decoded(F.col(pieces)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded with dropout 0.1 and decoded again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", fill("text").alias("text"))
    back = decode_documents(encode_documents(docs), text="decoded")
    return back.select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.hex(F.xxhash64("pieces")).alias("pieces_hash"),
        F.crc32(F.col("decoded").cast("binary")).alias("decoded_crc32"),
    )
