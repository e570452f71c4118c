"""Splitting oversized texts at natural boundaries by ranges.

A text is worked on in ranges of about ``RANGE`` characters that begin where the tokens of the whole text surely begin
anew (before a space between words, behind a line feed before a word), so the tokens of the ranges are those of the
text. The worker of a range tells a boundary table: for each place where a piece may end, the tokens up to there and
the kind of boundary (paragraph, line, sentence, word). The tables of a text are stitched in the order of their ranges,
prefix sums give the tokens from its start, pieces are chosen on the tables alone as these come in, and their texts are
cut out by offset from the ranges that they touch. ``split_files`` does the same for files, of which workers read byte
ranges with a halo; no worker loads a file.

Texts of up to one range, nearly all, go through the same steps inside one task without a shuffle. How a text is
divided into ranges makes no difference to its pieces.

A piece ends at the latest boundary of the best kind in the upper half of what fits, else at the best before; texts
without any place to cut are cut between tokens at a character. The next piece starts ``overlap`` tokens earlier, at a
word if one is near. Every piece is counted as a text of its own; one that exceeds the limit is split like a text.

Defined results. Texts within the limit, null or blank texts and kinds without limit give no rows; limits of null or
below 1 count as none; an overlap of null is 0, one of half the limit or more counts as just below half. Repeated
documents, also rows repeated whole under one doc_id, are split each and numbered each from 0. Empty tables give no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomfold.functions.decode import rows_of
from loomfold.llm.tokens import VOCABULARY, count, encoder
from loomfold.session import ship, spread, written

RANGE, MAX_KINDS = 32_768, 10_000

#: Characters around a range that tell the kinds of its edges.
AROUND = 4
#: Kinds of boundaries, the better the larger.
TOKEN, WORD, SENTENCE, LINE, PARAGRAPH = 0, 1, 2, 3, 4


def _table(codes) -> np.ndarray:
    """Which of the first 65536 characters are in a set; the last place stands for all beyond."""
    table = np.zeros(1 << 16, bool)
    table[list(codes)] = True
    return table


_SPACES = _table([9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288])
_CLOSERS = _table(map(ord, "。！？」』）】…、，)]}\"'.!?,;:"))
_STOPS, _WIDE_STOPS = _table(map(ord, ".!?")), _table(map(ord, "。！？"))
_ANEW = re.compile(r"(?<=\S)(?= \S)|(?<=\n)(?=\S)")


def parts_of(text: str, size: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the ranges of a text: each begins at the first place at or behind a multiple of ``size`` where tokens begin anew."""
    start = 0
    while start < len(text):
        found = _ANEW.search(text, (start // size + 1) * size)
        end = found.start() if found else len(text)
        yield start, end
        start = end


def boundary_table(text: str, path: str = VOCABULARY, beyond: int = -1, before: str = "", after: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """(offset in characters, tokens up to there, kind) of the places in a text where a piece may end, its end included.

    None if the text has no more tokens than ``beyond``. before, after: the characters around a range, ``AROUND`` or as
    many as there are, which tell the kinds of its edges.
    """
    encoding, lengths = encoder(path)
    ids = encoding.encode_ordinary(text)
    if len(ids) <= beyond:
        return None
    ids = np.array(ids, np.int64)
    token_ends = np.cumsum(lengths[ids]) if len(ids) else np.array([], np.int64)
    chars = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    # bytes up to each character, and the characters at which a token ends
    char_bytes = np.r_[0, np.cumsum(1 + (chars > 0x7F).astype(np.int64) + (chars > 0x7FF) + (chars > 0xFFFF))]
    at = np.searchsorted(char_bytes, token_ends)
    kind = np.full(len(chars) + 1, -1, np.int8)
    kind[at[char_bytes[at] == token_ends]] = TOKEN
    around = np.frombuffer((before + text + after).encode("utf-32-le", "replace"), np.uint32)
    for rank, places in _ends(around):
        places = places[(places >= len(before)) & (places <= len(before) + len(chars))] - len(before)
        kind[places[kind[places] >= TOKEN]] = rank
    kind[0] = -1
    offsets = np.flatnonzero(kind >= TOKEN)
    tokens = np.searchsorted(token_ends, char_bytes[offsets], side="right")
    return offsets, tokens, kind[offsets]


def _ends(chars: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(kind, places) from words to paragraphs: before a single space between words, behind a stop, behind line feeds."""
    n = len(chars)
    if n < 2:
        return
    low = np.minimum(chars, 0xFFFF)
    space = _SPACES[low]
    feed = chars == 10
    before_word = np.zeros(n, bool)
    before_word[1:-1] = (chars[1:-1] == 32) & ~space[:-2] & ~space[2:]
    behind = np.zeros(n, bool)
    yield WORD, np.flatnonzero(before_word)
    behind[1:] = _STOPS[low[:-1]] & before_word[1:] | _WIDE_STOPS[low[:-1]] & ~space[1:] & ~_CLOSERS[low[1:]]
    yield SENTENCE, np.flatnonzero(behind)
    line = np.zeros(n, bool)
    line[1:] = feed[:-1] & ~feed[1:]
    yield LINE, np.flatnonzero(line)
    empty = np.zeros(n, bool)
    empty[2:] = feed[:-2] & line[2:]
    empty[3:] |= feed[:-3] & (chars[1:-2] == 13) & line[3:]
    yield PARAGRAPH, np.flatnonzero(empty)


class Picker:
    """Chooses the pieces of a text while its boundary table comes in, range by range.

    Held are only the boundaries behind the start of the open piece, about as many as a piece has; how the table is
    divided makes no difference.
    """

    def __init__(self, limit: int, overlap: int):
        self.limit, self.overlap = limit, min(overlap, (limit - 1) // 2)
        self.start, self.start_tokens, self.done, self.found = 0, 0, -1, False
        self.offsets, self.tokens, self.kinds = np.array([], np.int64), np.array([], np.int64), np.array([], np.int8)

    def feed(self, offsets: np.ndarray, tokens: np.ndarray, kinds: np.ndarray) -> None:
        self.offsets, self.tokens, self.kinds = np.r_[self.offsets, offsets], np.r_[self.tokens, tokens], np.r_[self.kinds, kinds]

    def take(self, whole: bool) -> Iterator[tuple[int, int, int]]:
        """(start, end, tokens) of the pieces that are sure; with the whole table also the last. A text within the limit has none."""
        tokens, kinds, base = self.tokens, self.kinds, 0
        while len(tokens) > base:
            last = int(np.searchsorted(tokens, self.start_tokens + self.limit, side="right")) - 1
            if last == len(tokens) - 1:
                if whole and self.found:
                    yield self.start, int(self.offsets[-1]), int(tokens[-1]) - self.start_tokens
                break
            first = max(self.done + 1, int(np.searchsorted(tokens, self.start_tokens + self.limit // 2, side="right")))
            first = first if first <= last else self.done + 1
            last = max(first, last)  # one character of more tokens than the limit goes alone
            window = kinds[first : last + 1]
            end = first + int(np.flatnonzero(window == window.max())[-1])
            yield self.start, int(self.offsets[end]), int(tokens[end]) - self.start_tokens
            self.found, begin = True, end
            if self.overlap:
                back = int(np.searchsorted(tokens, tokens[end] - self.overlap, side="right")) - 1
                near = int(np.searchsorted(tokens, max(tokens[end] - 2 * self.overlap, self.start_tokens + 1), side="left"))
                words = np.flatnonzero(kinds[near : back + 1] >= WORD)
                begin = near + int(words[-1]) if len(words) else back if back >= near else end
            self.start, self.start_tokens, self.done = int(self.offsets[begin]), int(tokens[begin]), end
            base = begin
        self.offsets, self.tokens, self.kinds, self.done = self.offsets[base:], tokens[base:], kinds[base:], self.done - base


def choose(offsets: np.ndarray, tokens: np.ndarray, kinds: np.ndarray, limit: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start, end, tokens) of the pieces of a text, by its boundary table alone."""
    picker = Picker(limit, overlap)
    picker.feed(offsets, tokens, kinds)
    return list(picker.take(True))


def _anew_at(text: str, i: int) -> bool:
    """Whether tokens begin anew at a place whatever stands before."""
    if i <= 0 or i >= len(text):
        return True
    a, b = text[i - 1], text[i]
    if b == " ":
        return not a.isspace() and i + 1 < len(text) and not text[i + 1].isspace()
    return a == "\n" and not b.isspace() or a in "。！？" and b.isalnum()


def exact_pieces(
    text: str, pieces: Iterable[tuple[int, int, int]], limit: int, overlap: int = 0, base: int = 0, path: str = VOCABULARY, table: tuple | None = None
) -> Iterator[tuple[int, int, int, str]]:
    """(start, end, tokens, text) with the tokens of each piece as a text of its own; one that is too long is split like a text.

    With the boundary table of the text only the last word of a piece is tokenized again, where the piece begins and
    ends at places at which tokens begin anew: before it the tokens are those of the text.
    """
    stack = [(a, b) for a, b, _ in pieces][::-1]
    if table is not None:
        words = np.flatnonzero((table[2] == WORD) | (table[2] == SENTENCE))
        word_at, word_tokens = table[0][words], table[1][words]
    while stack:
        a, b = stack.pop()
        piece = text[a - base : b - base]
        n = None
        if table is not None and _anew_at(text, a - base) and _anew_at(text, b - base):
            k = int(np.searchsorted(word_at, b)) - 1
            start = 0 if a == 0 else int(np.searchsorted(table[0], a))
            if k >= 0 and word_at[k] > a and (a == 0 or table[0][start] == a) and _anew_at(text, int(word_at[k]) - base):
                n = int(word_tokens[k]) - (0 if a == 0 else int(table[1][start])) + count(text[int(word_at[k]) - base : b - base], path)
        n = count(piece, path) if n is None else n
        smaller = choose(*boundary_table(piece, path), limit, overlap) if n > limit else []
        if len(smaller) < 2:
            yield a, b, n, piece
        else:
            stack += [(a + c, a + d) for c, d, _ in reversed(smaller)]


def _limits(limits: DataFrame) -> dict[str, tuple[int, int]]:
    rows = limits.where("doc_kind IS NOT NULL AND max_tokens >= 1").groupBy("doc_kind").agg(F.min("max_tokens").alias("m"), F.max(F.coalesce("overlap_tokens", F.lit(0))).alias("o"))
    found = rows.limit(MAX_KINDS + 1).collect()
    if len(found) > MAX_KINDS:
        raise ValueError(f"more than {MAX_KINDS} kinds of documents")
    return {r.doc_kind: (int(r.m), max(0, int(r.o))) for r in found}


PIECES = "doc_id bigint, doc_kind string, piece_no int, start_char bigint, end_char bigint, n_tokens int, text string"
_PIECES = pa.schema([("doc_id", pa.int64()), ("doc_kind", pa.string()), ("piece_no", pa.int32()), ("start_char", pa.int64()), ("end_char", pa.int64()), ("n_tokens", pa.int32()), ("text", pa.string())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def split(documents: DataFrame, limits: DataFrame, path: str = VOCABULARY, size: int = RANGE) -> DataFrame:
    """(doc_id, doc_kind, piece_no, start_char, end_char, n_tokens, text): the pieces of texts beyond the limit of their kind."""
    ship(documents.sparkSession)
    limit_of = _limits(limits)
    rows = documents.where("doc_id IS NOT NULL AND doc_kind IS NOT NULL").where(F.col("text").rlike(r"(?U)\S")).select(F.col("doc_id").cast("bigint"), "doc_kind", "text")
    short = spread(rows).where(F.length("text") <= size)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, kind, text in rows_of([batch]):
                limit, overlap = limit_of.get(kind, (0, 0))
                # a token has at least one byte: short texts needn't be tokenized
                if limit and (len(text) * 4 > limit) and len(text.encode("utf-8", "replace")) > limit:
                    table = boundary_table(text, path, limit)
                    if table is None:
                        continue
                    pieces = exact_pieces(text, choose(*table, limit, overlap), limit, overlap, path=path, table=table)
                    out += [(doc, kind, i, *piece) for i, piece in enumerate(pieces)]
            yield _batch(out, _PIECES)

    return short.mapInArrow(cut, PIECES).unionByName(_split_long(rows.where(F.length("text") > size), limit_of, path, size))


TABLES = "text_no bigint, range_no int, offsets binary, tokens binary, kinds binary"


def _table_row(found: tuple[np.ndarray, np.ndarray, np.ndarray], start: int) -> tuple[bytes, bytes, bytes]:
    offsets, tokens, kinds = found
    return (offsets + start).astype(np.int64).tobytes(), tokens.astype(np.int64).tobytes(), kinds.astype(np.int8).tobytes()


def _picked(tables: DataFrame, limit_of: dict[str, tuple[int, int]]) -> DataFrame:
    """(text_no, doc_kind, piece_no, start, end) of boundary tables (text_no, doc_kind, range_no, offsets, tokens, kinds).

    The tables of a text come in the order of their ranges and are let go as pieces get sure: no row or list holds a
    text, and prefix sums of tokens are carried from range to range.
    """
    schema = pa.schema([("text_no", pa.int64()), ("doc_kind", pa.string()), ("piece_no", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, kind, picker, before, n = None, None, None, 0, 0
        for batch in batches:
            out: list[tuple] = []

            def hand_out(whole: bool) -> None:
                nonlocal n
                for a, b, _ in picker.take(whole):
                    out.append((at, kind, n, a, b))
                    n += 1

            for text_no, own_kind, offsets, tokens, kinds in rows_of([batch]):
                if text_no != at:
                    if picker is not None:
                        hand_out(True)
                    at, kind, picker, before, n = text_no, own_kind, Picker(*limit_of[own_kind]), 0, 0
                own = np.frombuffer(tokens, np.int64)
                picker.feed(np.frombuffer(offsets, np.int64), own + before, np.frombuffer(kinds, np.int8))
                before += int(own[-1]) if len(own) else 0
                hand_out(False)
            yield _batch(out, schema)
        if picker is not None:
            yield _batch([(at, kind, n + i, a, b) for i, (a, b, _) in enumerate(picker.take(True))], schema)

    sorted_tables = tables.select("text_no", "doc_kind", "offsets", "tokens", "kinds", "range_no").repartition("text_no").sortWithinPartitions("text_no", "range_no").drop("range_no")
    return sorted_tables.mapInArrow(pick, "text_no bigint, doc_kind string, piece_no bigint, start bigint, end bigint")


def _numbered(pieces: DataFrame) -> DataFrame:
    """Pieces (text_no, piece_no, part_no, parts, ...) numbered through where some consist of parts: a running sum.

    The sums of blocks of pieces are added up first, then those within a block, so no task has all pieces of a text.
    Texts without such pieces, nearly all, keep their numbers without a shuffle of their own.
    """
    odd = pieces.where("parts > 1").select("text_no").distinct()
    if odd.isEmpty():
        return pieces
    narrow = pieces.where("part_no = 0").select("text_no", "piece_no", (F.col("parts") - 1).alias("more")).join(odd, "text_no", "left_semi").withColumn("block", F.floor(F.col("piece_no") / 4096))
    earlier = Window.partitionBy("text_no").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = narrow.groupBy("text_no", "block").agg(F.sum("more").alias("sum")).withColumn("before", F.coalesce(F.sum("sum").over(earlier), F.lit(0))).drop("sum")
    inside = Window.partitionBy("text_no", "block").orderBy("piece_no").rowsBetween(Window.unboundedPreceding, -1)
    shifts = narrow.join(sums, ["text_no", "block"]).withColumn("shift", F.col("before") + F.coalesce(F.sum("more").over(inside), F.lit(0)))
    joined = pieces.join(shifts.where("shift > 0").select("text_no", "piece_no", "shift"), ["text_no", "piece_no"], "left")
    return joined.withColumn("piece_no", F.col("piece_no") + F.col("part_no") + F.coalesce("shift", F.lit(0))).drop("shift")


def _split_long(rows: DataFrame, limit_of: dict[str, tuple[int, int]], path: str, size: int) -> DataFrame:
    """The pieces of texts of several ranges: ranges, boundary tables, pieces by offset, texts of the ranges they touch."""
    known = rows.where(F.col("doc_kind").isin(*limit_of)) if limit_of else rows.where("false")
    numbered = known.withColumn("text_no", F.monotonically_increasing_id())
    part_schema = pa.schema([("text_no", pa.int64()), ("doc_id", pa.int64()), ("doc_kind", pa.string()), ("range_no", pa.int32()), ("from", pa.int64()), ("part", pa.string()), ("before", pa.string()), ("after", pa.string())])
    parts_kinds = "text_no bigint, doc_id bigint, doc_kind string, range_no int, from bigint, part string, before string, after string"

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text_no, doc, kind, text in rows_of(batches):
            for no, (a, b) in enumerate(parts_of(text, size)):
                yield _batch([(text_no, doc, kind, no, a, text[a:b], text[max(a - AROUND, 0) : a], text[b : b + AROUND])], part_schema)

    # a text is cut in one pass; its parts go to all tasks
    ranges = numbered.select("text_no", "doc_id", "doc_kind", "text").mapInArrow(part, parts_kinds).repartition("text_no", "range_no")
    table_schema = pa.schema([*part_schema, ("offsets", pa.binary()), ("tokens", pa.binary()), ("kinds", pa.binary())])

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([(*row, *_table_row(boundary_table(row[5], path, -1, row[6], row[7]), row[4])) for row in rows_of([batch])], table_schema)

    tables = written(ranges.mapInArrow(bound, f"{parts_kinds}, offsets binary, tokens binary, kinds binary"), "ranges")
    # where the ranges of a text begin tells which ones a piece touches
    texts = tables.select("text_no", "doc_id", "range_no", "from", "part")
    picked = _picked(tables, limit_of)
    edges = tables.select("text_no", (F.floor(F.col("from") / size)).cast("int").alias("cell"), "range_no", "from", F.length("part").alias("length"))
    cells = edges.select("text_no", "range_no", F.explode(F.sequence(F.col("cell"), F.floor((F.col("from") + F.col("length") - 1) / size).cast("int"))).alias("cell"))
    wanted = picked.withColumn("cell", F.explode(F.sequence(F.floor(F.col("start") / size).cast("int"), F.floor((F.col("end") - 1) / size).cast("int"))))
    touched = wanted.join(cells, ["text_no", "cell"]).drop("cell").distinct()
    met = touched.join(texts, ["text_no", "range_no"]).where((F.col("from") < F.col("end")) & (F.col("from") + F.length("part") > F.col("start")))
    low = F.greatest(F.col("start") - F.col("from"), F.lit(0))
    cut = F.substring("part", (low + 1).cast("int"), (F.least(F.col("end") - F.col("from"), F.length("part")) - low).cast("int"))
    pieces_of = met.groupBy("text_no", "doc_id", "doc_kind", "piece_no", "start", "end")
    joined = pieces_of.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("range_no", cut.alias("t")))), lambda x: x["t"]), "").alias("text"))
    schema = pa.schema([("text_no", pa.int64()), ("part_no", pa.int32()), ("parts", pa.int32()), *_PIECES])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text_no, doc, kind, no, start, end, text in rows_of([batch]):
                parts = list(exact_pieces(text, [(start, end, 0)], *limit_of[kind], base=start, path=path))
                out += [(text_no, i, len(parts), doc, kind, no, *p) for i, p in enumerate(parts)]
            yield _batch(out, schema)

    done = joined.select("text_no", "doc_id", "doc_kind", "piece_no", "start", "end", "text").mapInArrow(finish, f"text_no bigint, part_no int, parts int, {PIECES}")
    final = _numbered(written(done, "pieces"))
    return final.select("doc_id", "doc_kind", F.col("piece_no").cast("int").alias("piece_no"), "start_char", "end_char", "n_tokens", "text")


# -- files by byte ranges -------------------------------------------------------

FILE_RANGE = 4 << 20
#: Places in UTF-8 bytes where tokens begin anew: before a space between words, behind a line feed; never before a byte
#: that may begin a wide space (fixed value).
_ANEW_BYTES = re.compile(rb"(?<=[!-~])(?= [!-~])|(?<=\n)(?=[!-~\xc3-\xdf\xe4-\xf4])")
FILE_PIECES = "path string, piece_no bigint, start_byte bigint, end_byte bigint, n_tokens int, text string"


def _opened(path: str):
    """A file of any file system that pyarrow knows, read at offsets."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem().open_input_file(unquote(re.sub("^file:/+", "/", path)))
    system, where = fs.FileSystem.from_uri(path)
    return system.open_input_file(where)


def _next_anew(file, length: int, at: int, halo: int) -> int:
    """The first place at or behind ``at`` where tokens begin anew, found in a halo that is read on as long as there is none."""
    if at <= 0 or at >= length:
        return max(0, min(at, length))
    while at < length:
        data = file.read_at(min(halo, length - at) + 2, at - 1)
        if found := _ANEW_BYTES.search(data, 1):
            return at - 1 + found.start()
        at += max(len(data) - 2, 1)
    return length


def split_files(spark: SparkSession, paths: str | list[str], limit: int, overlap: int = 0, path: str = VOCABULARY, size: int = FILE_RANGE, halo: int = 1 << 16) -> DataFrame:
    """(path, piece_no, start_byte, end_byte, n_tokens, text): the pieces of UTF-8 text files with more tokens than the limit.

    No worker loads a file: each reads a range of bytes and a halo behind it, in which it finds where its range and the
    next begin, and tells its boundary table; the tables are stitched, and pieces are read again by their offsets.
    Files within the limit, blank and empty ones have no rows. Bytes that are no UTF-8 are read as replacement characters.
    """
    ship(spark)
    files = spark.read.format("binaryFile").load(paths).select("path", "length").where("length > 0")
    named = written(files.withColumn("text_no", F.monotonically_increasing_id()), "files")
    ranges = named.select("*", F.explode(F.sequence(F.lit(0), F.floor((F.col("length") - 1) / size).cast("int"))).alias("range_no")).repartition("text_no", "range_no")

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, length, text_no, no in rows_of(batches):
            with _opened(name) as file:
                a, b = _next_anew(file, length, no * size, halo), _next_anew(file, length, (no + 1) * size, halo)
                text = file.read_at(b - a, a).decode("utf-8", "replace") if b > a else ""
                first = max(a - 4 * AROUND, 0)
                before, after = file.read_at(a - first, first).decode("utf-8", "replace")[-AROUND:], file.read_at(min(4 * AROUND, length - b), b).decode("utf-8", "replace")[:AROUND]
            if text:
                offsets, tokens, kinds = boundary_table(text, path, -1, before, after)
                sizes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
                at = np.r_[0, np.cumsum(1 + (sizes > 0x7F).astype(np.int64) + (sizes > 0x7FF) + (sizes > 0xFFFF))]
                yield _batch([(text_no, no, *_table_row((at[offsets], tokens, kinds), a), not text.isspace())], table_schema)

    table_schema = pa.schema([("text_no", pa.int64()), ("range_no", pa.int32()), ("offsets", pa.binary()), ("tokens", pa.binary()), ("kinds", pa.binary()), ("said", pa.bool_())])
    tables = written(ranges.select("path", "length", "text_no", "range_no").mapInArrow(bound, f"{TABLES}, said boolean"), "ranges")
    said = tables.where("said").select("text_no").distinct()
    picked = _picked(tables.join(said, "text_no", "left_semi").withColumn("doc_kind", F.lit("file")), {"file": (limit, overlap)})
    schema = pa.schema([("text_no", pa.int64()), ("part_no", pa.int32()), ("parts", pa.int32()), ("path", pa.string()), ("piece_no", pa.int64()), ("start_byte", pa.int64()), ("end_byte", pa.int64()), ("n_tokens", pa.int32()), ("text", pa.string())])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text_no, name, no, start, end in rows_of([batch]):
                with _opened(name) as file:
                    text = file.read_at(end - start, start).decode("utf-8", "replace")
                parts = list(exact_pieces(text, [(0, len(text), 0)], limit, overlap, path=path))
                byte = lambda i, text=text: len(text[:i].encode("utf-8"))
                out += [(text_no, i, len(parts), name, no, start + byte(a), start + byte(b), n, t) for i, (a, b, n, t) in enumerate(parts)]
            yield _batch(out, schema)

    wanted = picked.join(named.select("text_no", "path"), "text_no").select("text_no", "path", "piece_no", "start", "end")
    done = wanted.repartition("text_no", F.floor(F.col("piece_no") / 256)).mapInArrow(finish, f"text_no bigint, part_no int, parts int, {FILE_PIECES}")
    return _numbered(written(done, "pieces")).select("path", "piece_no", "start_byte", "end_byte", "n_tokens", "text")
