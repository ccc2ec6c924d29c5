"""Language of documents, pages and segments (problem 1) by cross-parsing entropy.

For each language a suffix automaton of labelled text recognises every string that occurs in it.  A
segment is parsed greedily into the longest phrases the automaton knows; the fewer phrases, the
closer the segment is to the language.  Phrases are normalised to bits by the size of the training
text, and the language that needs the fewest bits wins.  The confidence is the share of the winner
when bits per letter are turned into odds.

The winner must also be near enough.  Held-out paragraphs say how many bits a letter of a text costs in the
best language other than its own.  A segment of 30 letters or more is in none of the languages, ``und`` with
confidence 0, if it costs more than most such texts do (the quantile ``far``) and does not stand apart from
the second language either.  That holds for languages without labelled text and for scripts no automaton knows.

The automata are fitted on a bounded sample of labelled rows: per language at most ``train_docs``
documents of at most ``train_letters`` characters, chosen by a hash of the id and taken whole.  Labels may
be wrong, so the sample is split into halves, each half is judged by automata of the other, and
paragraphs that are not clearly (``clear``) nearest to the language of their label are left out, twice, the
second time by the cleaner automata; a language of which nothing stays has none.

The alphabet has no bound: the commonest letters have a class each, any other is spelt with an escape
and three digits.  All segments of a batch are parsed side by side, one step of the parse being one
look-up for every segment and language in a dense transition table.  Long texts lie in pieces; a piece
goes on in the state its predecessor ends in, which is settled by parsing again what began in another
state, so the count is that of the whole text.

A null or blank text has no row; one without letters, or too short to tell (two letters), gets ``und`` with
confidence 0.  Ties go to the alphabetically first language.  Repeated rows give one row; of rows of one
id and number that differ the one with the greatest label, then language, stays.  An empty table gives none."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .canon import canonical

# Names and codes of languages.
NAMES = {
    "en": "en eng english englisch anglais inglés", "de": "de deu ger german deutsch allemand alemán", "fr": "fr fra fre french français französisch francés",
    "es": "es spa spanish español espanol castellano spanisch espagnol", "pt": "pt por portuguese português portugues", "it": "it ita italian italiano italien",
    "nl": "nl nld dut dutch nederlands", "ru": "ru rus russian русский", "pl": "pl pol polish polski", "sv": "sv swe swedish svenska", "da": "da dan danish dansk",
    "cs": "cs ces cze czech čeština", "uk": "uk ukr ukrainian українська", "tr": "tr tur turkish türkçe", "fi": "fi fin finnish suomi", "ro": "ro ron rum romanian română",
}
# The two-letter codes of ISO 639-1, without "na", which stands for "not available" too.
CODES = (
    "aa ab ae af ak am an ar as av ay az ba be bg bh bi bm bn bo br bs ca ce ch co cr cs cu cv cy da de dv dz ee el en eo es et eu fa ff fi fj fo fr fy ga gd gl gn gu gv ha he hi ho hr ht hu hy hz "
    "ia id ie ig ii ik io is it iu ja jv ka kg ki kj kk kl km kn ko kr ks ku kv kw ky la lb lg li ln lo lt lu lv mg mh mi mk ml mn mr ms mt my nb nd ne ng nl nn no nr nv ny oc oj om or os pa pi pl ps pt "
    "qu rm rn ro ru rw sa sc sd se sg si sk sl sm sn so sq sr ss st su sv sw ta te tg th ti tk tl tn to tr ts tt tw ty ug uk ur uz ve vi vo wa wo xh yi yo za zh zu"
)
ALIASES = {code: code for code in CODES.split()} | {alias: code for code, names in NAMES.items() for alias in names.split()}
CLASSES, PIECE, LANES = 64, 2000, 2048
COMMON = 60  # classes 1 to 60; 61 is the escape, 0 stands for what no automaton knows


def label_code(label: Column) -> Column:
    """Two-letter code a label names, in whatever spelling; null if it names none.  Understands codes
    with regions, names, ``__label__xx``, ``{"xx": score}`` and ``[score, 'XX']``."""
    token = F.regexp_extract(F.regexp_replace(F.lower(label), "__label__", ""), r"\p{L}{2,}", 0)
    return F.create_map(*[F.lit(x) for pair in ALIASES.items() for x in pair])[token]


_NOT_LETTER = re.compile(r"[\W\d_]+")


def letters(text: str) -> str:
    """Lower-case letters with single spaces, a space at both ends."""
    return f" {_NOT_LETTER.sub(' ', text.lower()).strip()} "


def suffix_automaton(text: list[int], classes: int) -> np.ndarray:
    """Dense transitions [state, class], -1 where there is none; state 0 is the root."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        cur = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    table = np.full((len(nxt), classes), -1, np.int32)
    for s, moves in enumerate(nxt):
        for c, t in moves.items():
            table[s, c] = t
    return table


class Parser:
    """Automata of several languages over one alphabet."""

    def __init__(self, texts: dict[str, str]):
        self.languages = sorted(texts)
        points = np.frombuffer("".join(texts.values()).encode("utf-32-le", "surrogatepass"), np.uint32)
        letters_, counts = np.unique(points, return_counts=True)
        known = letters_[np.argsort(-counts, kind="stable")[:COMMON]]
        self.classes = np.zeros(0x110000, np.uint8)
        self.classes[known] = np.arange(1, len(known) + 1)
        tables, self.base, at = [], [], 0
        for lang in self.languages:
            t = suffix_automaton(self.codes(texts[lang]).tolist(), CLASSES)
            t[t >= 0] += at
            t[:, 0] = -1
            self.base.append(at)
            tables.append(t)
            at += len(t)
        flat = np.concatenate(tables).ravel()
        self.table = np.where(flat >= 0, flat * CLASSES, -1).astype(np.int32)  # states are kept as offsets
        self.bits = np.array([np.log2(max(4, len(texts[x]))) for x in self.languages])
        roots = np.stack([t[0] for t in tables])
        self.base = np.array(self.base, np.int32) * CLASSES
        self.roots = np.where(roots >= 0, roots * CLASSES, self.base[:, None]).astype(np.int32)
        self.most = np.inf  # bits a letter beyond which a text may be in none

    def codes(self, text: str) -> np.ndarray:
        """Classes of the letters; a letter without one is spelt as an escape and three digits."""
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        found = self.classes[points]
        rare = np.nonzero(found == 0)[0]
        if not len(rare):
            return found
        size = np.ones(len(points), np.int64)
        size[rare] = 4
        end = np.cumsum(size)
        out = np.repeat(found, size)
        for j, digit in enumerate((None, COMMON * COMMON, COMMON, 1)):
            out[end[rare] - 4 + j] = COMMON + 1 if digit is None else points[rare] // digit % COMMON + 1
        return out

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits [text, language] and letters of each text, which ``letters`` has prepared."""
        pieces, of, goes_on = [], [], []
        for i, t in enumerate(texts):
            c = self.codes(t)
            for b in range(0, len(c), PIECE):
                pieces.append(c[b : b + PIECE])
                of.append(i)
                goes_on.append(b > 0)
        owner, later = np.array(of, np.int64), np.array(goes_on, bool)
        begin = np.repeat(self.base[:, None], len(pieces), 1)
        count, end = self.parse(pieces, begin)
        todo = np.nonzero(later)[0]
        while len(todo):  # where a piece began in another state than its predecessor ended in
            todo = todo[(begin[:, todo] != end[:, todo - 1]).any(0)]
            begin[:, todo] = end[:, todo - 1]
            count[:, todo], now = self.parse([pieces[p] for p in todo], begin[:, todo])
            moved = todo[(now != end[:, todo]).any(0)] + 1
            end[:, todo] = now
            todo = moved[(moved < len(pieces)) & later[np.minimum(moved, len(pieces) - 1)]] if len(moved) else moved
        total = np.zeros((len(texts), len(self.languages)))
        np.add.at(total, owner, (count + ~later).T)
        return total * self.bits, np.array([len(t) for t in texts])

    def parse(self, pieces: list[np.ndarray], begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrase ends and last state [language, piece] of pieces that begin in given states."""
        counts, ends = np.zeros(begin.shape, np.int32), begin.copy()
        sizes = np.array([len(p) for p in pieces], np.int64)
        order = np.argsort(-sizes, kind="stable")
        for b in range(0, len(order), LANES):
            part = order[b : b + LANES]
            n = sizes[part]
            grid = np.zeros((int(n[0]), len(part)), np.uint8)
            for j, p in enumerate(part):
                grid[: n[j], j] = pieces[p]
            live = np.searchsorted(-n, -np.arange(int(n[0])), "left")  # lanes longer than the step
            state = begin[:, part].copy()
            count = np.zeros(state.shape, np.int32)
            last = state
            for t in range(int(n[0])):
                m = int(live[t])
                c = grid[t, :m]
                if m < state.shape[1]:
                    last[:, m : state.shape[1]] = state[:, m:]
                state = self.table.take(state[:, :m] + c)
                miss = state < 0
                count[:, :m] += miss
                np.copyto(state, self.roots.take(c, 1), where=miss)
            last[:, : state.shape[1]] = state
            counts[:, part], ends[:, part] = count, last
        return counts, ends

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Language, confidence, bits and letters of each prepared text."""
        if not texts:
            return [], np.zeros(0), np.zeros((0, len(self.languages))), np.zeros(0)
        bits, n = self.phrases(texts)
        return *self.decide(bits, n), bits, n

    def decide(self, bits: np.ndarray, n: np.ndarray, texts: np.ndarray | int = 1) -> tuple[list[str], np.ndarray]:
        """Language and confidence from the bits and letters of ``texts`` texts together."""
        best = bits.argmin(1)
        odds = np.exp2(-(bits - bits.min(1, keepdims=True)) / np.sqrt(np.maximum(n, 1))[:, None])
        two = np.sort(bits, 1)[:, :2]
        known = (n > 2 * texts) & ((n < SURE_LETTERS) | (two[:, 0] <= self.most * n) | (two[:, -1] >= APART * two[:, 0]))
        return [self.languages[i] if k else "und" for i, k in zip(best, known)], np.where(known, (1 / odds.sum(1)).round(4), 0.0)


SURE_LETTERS, APART = 30, 1.3


def train(docs: DataFrame, id_col: str, text_col: str, label_col: str, train_docs: int = 24, train_letters: int = 20_000, far: float = 0.9, rounds: int = 2, clear: float = 0.9) -> Parser:
    """Fit on the bounded sample of labelled rows described above."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), label_code(F.col(label_col)).alias("code")).where(F.col("code").isNotNull() & F.length("t").between(40, train_letters))
    counts = {r[0]: r[1] for r in rows.groupBy("code").count().collect()}
    if not counts:
        return Parser({"und": "  "})
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(2e6 * train_docs / n) + 1)])
    sample = rows.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share[F.col("code")]).dropDuplicates(["id"]).orderBy(F.xxhash64("id")).limit(3 * train_docs * len(counts)).collect()
    taken: dict[str, list[str]] = {}
    for r in sample:
        if len(taken.setdefault(r["code"], [])) < train_docs:
            taken[r["code"]].append(r["t"])
    kept = {k: [p for t in v for p in map(letters, canonical(t).split("\n\n")) if len(p) > 40] for k, v in taken.items()}
    kept = {k: v for k, v in sorted(kept.items()) if v}
    if not kept:
        return Parser({"und": "  "})
    clean, other = {k: [v[0::2], v[1::2]] for k, v in kept.items()}, []
    for _ in range(rounds):  # the automata that judge get cleaner, what they judge is always the whole sample
        halves = [Parser({k: "".join(v[h] or v[1 - h]) for k, v in clean.items() if v[0] or v[1]}) for h in (0, 1)]
        other = []
        for k, v in kept.items():
            sides = [[], []]
            for h in (0, 1):
                judge, texts = halves[1 - h], v[h::2]
                if k not in judge.languages or not texts:
                    continue
                bits, n = judge.phrases(texts)
                j = judge.languages.index(k)
                rest = np.delete(bits, j, 1).min(1) if bits.shape[1] > 1 else np.full(len(bits), np.inf)
                good = bits[:, j] <= clear * rest
                sides[h] = [t for t, g in zip(texts, good) if g]
                other += (rest / n)[good & np.isfinite(rest)].tolist()
            clean[k] = sides
    clean = {k: "".join(v[0] + v[1]) for k, v in clean.items() if v[0] or v[1]}
    parser = Parser(clean or {k: "".join(v) for k, v in kept.items()})
    if other:
        parser.most = float(np.quantile(other, far))
    return parser


_SIX = re.compile(r"(?:[^\W_]+[\W_]+){5}[^\W_]")


def _segments(parser, split: bool):
    """(id, no, text, label) to (id, no, lang, confidence, counts, label, bits, letters): counts says
    whether the segment is a sentence of six words; no -1 is the whole text, if it was split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p: Parser = parser.value
        for batch in batches:
            nos, texts, full, rows = [], [], [], []
            for i, (number, text) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                if text is None or not text.strip():
                    continue
                plain = canonical(text) == text
                for j, s in enumerate(text.split("\n\n") if split else [text]):
                    form = (s if plain else canonical(s)).strip()
                    if form:
                        rows.append(i)
                        nos.append(j if split else number)
                        texts.append(letters(form))
                        full.append(form[-1] in ".!?" and bool(_SIX.search(form)))
            lang, conf, bits, n = p.judge(texts)
            if split and rows:
                at = np.array(rows)
                first = np.unique(at, return_index=True)[1]
                total, size = np.add.reduceat(bits, first, 0), np.add.reduceat(n, first)
                langs, sure = p.decide(total, size, np.diff([*first, len(at)]))
                rows += at[first].tolist()
                nos += [-1] * len(first)
                lang += langs
                conf = np.concatenate([conf, sure])
                full += [False] * len(first)
                bits, n = bits[:0], n[:0]
            at = pa.array(rows, pa.int64())
            columns = [batch.column(0).take(at), pa.array(nos, pa.int64()), pa.array(lang, pa.string()), pa.array(conf, pa.float64()), pa.array(full, pa.bool_()), batch.column(3).take(at)]
            if not split:
                columns += [pa.array(n, pa.int64()), *(pa.array(bits[:, j], pa.float64()) for j in range(len(p.languages)))]
            yield pa.RecordBatch.from_arrays(columns, ["rec_id", "seg_no", "lang", "confidence", "counts", "label", *([] if split else ["letters", *(f"bits{j}" for j in range(len(p.languages)))])])

    return run


def _once(found: DataFrame, extra: tuple = ()) -> DataFrame:
    cells = F.max(F.struct("label", "lang", "confidence", "counts", *extra)).alias("r")
    return found.groupBy("rec_id", "seg_no").agg(cells).select("rec_id", "seg_no", "r.lang", "r.confidence", "r.counts", "r.label", *[f"r.{c}" for c in extra])


def document_languages(docs: DataFrame, parser, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """(rec_id, seg_no, lang, confidence, counts, label): each document (seg_no -1) and paragraph."""
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("rec_id"), F.lit(0).cast("long").alias("no"), F.col(text_col).alias("t"), label_code(F.col(label_col)).alias("label")).where("t IS NOT NULL")
    return _once(rows.mapInArrow(_segments(parser, True), f"rec_id {kind}, seg_no long, lang string, confidence double, counts boolean, label string"))


def page_languages(items: DataFrame, parser, label_col: str = "language_id_whole_page_fasttext", wholes: bool = True) -> DataFrame:
    """The same for the text rows of interleaved pages and, with ``wholes``, for the whole page (seg_no -1,
    the place of its metadata row); the label is that of the metadata row."""
    rows = items.where("modality = 'text' AND text_content IS NOT NULL").select(F.col("sample_id").alias("rec_id"), F.col("position").cast("long").alias("no"), F.col("text_content").alias("t"), F.lit(None).cast("string").alias("label"))
    sums = [f"bits{j}" for j in range(len(parser.value.languages))]
    found = rows.mapInArrow(_segments(parser, False), "rec_id string, seg_no long, lang string, confidence double, counts boolean, label string, letters long, " + ", ".join(f"{c} double" for c in sums))
    columns = ["rec_id", "seg_no", "lang", "confidence", "counts"]
    if wholes:
        once = _once(found, ("letters", *sums))
        pages = once.groupBy("rec_id").agg(F.count("*").alias("texts"), *[F.sum(c).alias(c) for c in ("letters", *sums)])

        def decided(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                lang, sure = parser.value.decide(np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in sums], 1), b.column("letters").to_numpy(zero_copy_only=False), b.column("texts").to_numpy(zero_copy_only=False))
                yield pa.RecordBatch.from_arrays([b.column("rec_id"), pa.array(np.full(b.num_rows, -1)), pa.array(lang, pa.string()), pa.array(sure), pa.array(np.zeros(b.num_rows, bool))], columns)

        segments = once.select(columns).unionByName(pages.mapInArrow(decided, "rec_id string, seg_no long, lang string, confidence double, counts boolean"))
    else:
        segments = found.select(columns).distinct()
    labels = items.where("modality = 'metadata'").select(F.col("sample_id").alias("rec_id"), label_code(F.col(label_col)).alias("label")).groupBy("rec_id").agg(F.max("label").alias("label"))
    return segments.join(labels, "rec_id", "left")


def languages(docs: DataFrame, items: DataFrame, wholes: bool = True) -> DataFrame:
    """(src, rec_id, seg_no, lang, confidence, counts, label) of documents and interleaved pages."""
    parser = docs.sparkSession.sparkContext.broadcast(train(docs, "doc_id", "text", "lang"))
    a = document_languages(docs, parser).withColumn("rec_id", F.col("rec_id").cast("string")).withColumn("src", F.lit("documents"))
    return a.unionByName(page_languages(items, parser, wholes=wholes).withColumn("src", F.lit("interleaved")))


def mislabelled(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Segments whose language is not the one of the label, or whose label names none.  A segment in none
    of the known languages is reported as ``und`` by ``languages`` and has no row here."""
    return languages(docs, items, wholes=False).where("counts AND lang <> 'und' AND (label IS NULL OR label <> lang)").select("src", "rec_id", "seg_no", "lang").distinct()
