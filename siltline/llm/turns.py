"""Clean speaker turns from transcripts (problem 6) by a semi-Markov conditional model.

Each segment is read first: times, speaker labels, sound annotations and hesitation sounds are taken
out of its text, and the label is brought to one form (``speaker_<number>`` or the role in lower
case), from the speaker field or else from the text.  Segments without speech go.

The rest, in order of start, is cut into turns by the best-scoring segmentation.  What is scored is a
whole turn of one speaker; its features are

* the labels of all its segments that agree with the speaker, and those that do not; a segment that is
  repeated with different labels votes for each of them with a part,
* that it is opened, the pause before it, whether the sentence before runs on into it, and whether its
  first segment has no label,
* the pauses and the finished sentences inside it,
* its number of segments, up to ``LONGEST``, beyond which more make no difference.

Adjacent turns differ in their speaker.  The weights are estimated with a margin from a bounded sample of
entries (``train_entries``, chosen by a hash of the id) in which no label is disputed; there the turns
are known, a segment without label belonging to the speaker before it.  So labels decide where they are
clear, and pauses, continuity and length where they are not.  Before the first label a segment belongs
to the first turn.

An entry that is repeated counts once; entries of one id that differ are one recording.  Of segments with
the same start and end the words of the first with a label (else the first) stay.  Segments without a
start or with a start that is no number are left out; a missing end adds nothing to its turn's end.
Without any label in an entry the speaker is ``unknown``.  Null segments, empty entries and empty tables
give no row.

A row is read where it lies; only rows of ids that have several are brought together."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .canon import canonical

_CLOCK = r"\d{1,2}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?"
TIMES = re.compile(rf"[\[(<{{]?\s*{_CLOCK}(?:\s*-+>\s*{_CLOCK})?\s*[\])>}}]?|[\[(<{{]\s*\d+(?:\.\d+)?\s*(?:s|sec|ms)\s*[\])>}}]")
SOUNDS = re.compile(r"\[+[^\[\]]*\]+|\(+[^()]*\)+|<+[^<>]*>+|\{+[^{}]*\}+|\*+[^*\s][^*]*\*+|♪[^♪]*♪|[♪♫]+")
HESITATION = re.compile(r"(?:u+h+m*|u+m+|e+r+m*|e+h+m*|a+h+m*|h+m+|m{2,}|m+h+m+|u+h+u+h+)(?:-(?:u+h+m*|u+m+|e+r+m*|h+m+|m{2,}))*", re.I)
_NUMBERED = re.compile(r"(?:speaker|spkr?|s)[\s_\-#]*0*(\d+)", re.I)
# Roles that stand before a text, and labels that name nobody.
ROLES = {"moderator", "host", "guest", "caller", "interviewer", "interviewee", "operator", "agent", "customer", "narrator", "presenter", "announcer", "reporter", "chair", "audience", "panelist", "teacher", "student", "doctor", "patient", "client"}
NOBODY = {"", "unknown", "none", "null", "nan", "n/a", "na", "unk", "speaker", "spk", "?", "-"}
_IN_TEXT = re.compile(rf"\s*(?:>+\s*)?[\[(]?\s*((?:speaker|spkr?|s)[\s_\-#]*\d+|{'|'.join(sorted(ROLES))})\s*(?:\(cont\.?\))?\s*[\])]?\s*(?::|\s[-–—](?=\s)|>+)\s*", re.I)
_LETTER = re.compile(r"[^\W_]")
_PREFIX = re.compile(r"\s*(?:>+\s*)?([^\W\d_][\w .'-]{0,40}?)\s*:\s+")


@lru_cache(maxsize=100_000)
def label(name: str | None) -> str | None:
    """One form of a speaker label; None if it names nobody."""
    if name is None:
        return None
    plain = re.sub(r"\(.*?\)", "", canonical(name)).strip(" \t\n[](){}<>:;,.*_-\"'").lower()
    if plain in NOBODY:
        return None
    m = _NUMBERED.fullmatch(plain) or re.fullmatch(r"0*(\d+)", plain)
    return f"speaker_{m[1]}" if m else re.sub(r"\s+", " ", plain)


def speech(text: str | None, own: frozenset[str] = frozenset()) -> tuple[list[str], str | None]:
    """The words that are spoken and the label found in the text: a number, a role, or one of the
    labels (``own``) that the entry's speaker fields use."""
    if not text:
        return [], None
    text = canonical(text)
    if _TIMED.search(text):
        text = TIMES.sub(" ", text)
    found = None
    while m := _in_text(text, own):
        found = found or label(m[1])
        text = text[m.end() :]
    if _MARKED.search(text):
        text = SOUNDS.sub(" ", text)
        if not found and (m := _in_text(text, own)):
            found, text = label(m[1]), text[m.end() :]
    words = [w for w in text.split() if _LETTER.search(w) and not (w.lstrip("\"'([")[:1] in "uUeEaAhHmM" and HESITATION.fullmatch(w.strip(".,!?…:;-–—\"'()[]")))]
    return words, found


_TIMED, _MARKED = re.compile(r"\d"), re.compile(r"[\[({<*♪♫]")


def _in_text(text: str, own: frozenset[str]) -> re.Match | None:
    m = _IN_TEXT.match(text)
    if not m and own and (p := _PREFIX.match(text)) and label(p[1]) in own:
        return p
    return m


LONGEST = 4
FEATURES = ("agrees", "disagrees", "opens", "pause_before", "runs_on", "opens_unlabelled", "pause_inside", "ends_inside", *(f"length_{k}" for k in range(1, LONGEST + 1)))
# the weights before any estimate, in the order of FEATURES
START = np.array([8.0, -8.0, -2.0, 0.5, -0.5, -4.0, -0.25, -0.25, *[0.0] * LONGEST])


class Lanes:
    """Entries side by side: votes [entry, step, speaker] and what the features need, padded to the longest."""

    def __init__(self, entries: list[list[tuple[float, float, dict[str, float], list[str]]]]):
        self.speakers = [sorted({w for r in rows for w in r[2]}) or ["unknown"] for rows in entries]
        b, t, s = len(entries), max(map(len, entries)), max(map(len, self.speakers))
        self.size = np.array([len(rows) for rows in entries])
        self.votes, self.real = np.zeros((b, t, s)), np.zeros((b, s), bool)
        self.pause, self.runs_on, self.ends = np.zeros((b, t)), np.zeros((b, t)), np.zeros((b, t))
        for i, rows in enumerate(entries):
            at = {w: k for k, w in enumerate(self.speakers[i])}
            self.real[i, : len(at)] = True
            for j, (start, _, votes, words) in enumerate(rows):
                for w, v in votes.items():
                    self.votes[i, j, at[w]] = v
                if j:
                    self.pause[i, j] = min(1.0, max(0.0, start - max(rows[j - 1][:2])) / 2)
                    self.ends[i, j] = rows[j - 1][3][-1][-1:] in ".!?"
                    self.runs_on[i, j] = not self.ends[i, j] and words[0][:1].islower()
        self.labelled = self.votes.sum(2) > 0

    def best(self, w: np.ndarray, wrong: np.ndarray | None = None) -> np.ndarray:
        """Speaker [entry, step] of the best segmentation into whole turns.  The state is the speaker and the
        turn's length so far; ``wrong`` is added to the score of each speaker, for the margin."""
        b, t, s = self.votes.shape
        length = w[8:]
        steps = np.r_[length[1:] - length[:-1], 0.0]  # what one more segment adds to a turn
        emit = w[0] * self.votes + w[1] * (self.votes.sum(2, keepdims=True) - self.votes)
        if wrong is not None:
            emit = emit + wrong
        emit = np.where(self.real[:, None, :], emit, -1e9)
        opens = w[2] + length[0] + w[3] * self.pause + w[4] * self.runs_on + w[5] * ~self.labelled
        stays = w[6] * self.pause + w[7] * self.ends
        score = np.full((b, s, LONGEST), -1e9)
        score[:, :, 0] = emit[:, 0] + w[2] + length[0]
        back = np.zeros((t, b, s, 2), np.int32)  # of a turn's first segment: the state before; of the longest: whether it was the longest before
        every, spread = np.arange(b), np.arange(s)
        for j in range(1, t):
            flat = score.reshape(b, -1)
            top = flat.argmax(1)
            best1 = flat[every, top]
            other = np.where((spread[None, :] == (top // LONGEST)[:, None])[:, :, None], -np.inf, score).reshape(b, -1)
            second = other.argmax(1)
            best2 = other[every, second]
            mine = spread[None, :] == (top // LONGEST)[:, None]
            before = np.where(mine, second[:, None], top[:, None])
            fresh = np.where(mine, best2[:, None], best1[:, None]) + opens[:, j, None]
            new = np.empty_like(score)
            new[:, :, 0] = fresh
            new[:, :, 1:] = score[:, :, :-1] + steps[:-1]
            longer = score[:, :, -1] > new[:, :, -1]
            new[:, :, -1] = np.maximum(new[:, :, -1], score[:, :, -1])
            new[:, :, 1:] += stays[:, j, None, None]
            new += emit[:, j][:, :, None]
            alive = j < self.size
            score = np.where(alive[:, None, None], new, score)
            back[j, :, :, 0], back[j, :, :, 1] = before, longer
        state = score.reshape(b, -1)[:, ::-1].argmax(1)
        state = s * LONGEST - 1 - state  # of equal ones the longer turn
        who = np.zeros((b, t), np.int64)
        for j in range(t - 1, -1, -1):
            speaker, m = state // LONGEST, state % LONGEST
            alive = j < self.size
            who[:, j] = np.where(alive, speaker, 0)
            if j:
                before, longer = back[j, every, speaker, 0], back[j, every, speaker, 1]
                stay = speaker * LONGEST + np.where((m == LONGEST - 1) & (longer == 1), m, m - 1)
                state = np.where(alive, np.where(m == 0, before, stay), state)
        return who

    def features(self, who: np.ndarray) -> np.ndarray:
        """Sums of the features of all turns of a segmentation given by its speakers."""
        b, t, _ = self.votes.shape
        alive = np.arange(t)[None, :] < self.size[:, None]
        mine = np.take_along_axis(self.votes, who[:, :, None], 2)[:, :, 0] * alive
        total = self.votes.sum(2) * alive
        first = np.ones((b, t), bool)
        first[:, 1:] = who[:, 1:] != who[:, :-1]
        opens, later = first & alive, first & alive & (np.arange(t) > 0)[None, :]
        inside = ~first & alive
        at = np.nonzero(opens.ravel())[0]
        ends = np.minimum(np.r_[at[1:], b * t], (at // t) * t + self.size[at // t])
        sizes = np.bincount(np.minimum(ends - at, LONGEST), minlength=LONGEST + 1)[1:]
        return np.array([mine.sum(), (total - mine).sum(), opens.sum(), self.pause[later].sum(), self.runs_on[later].sum(), (later & ~self.labelled).sum(), self.pause[inside].sum(), self.ends[inside].sum(), *sizes], float)

    def ruled(self) -> np.ndarray:
        """The known speakers where no label is disputed: that of the label, else of the segment before."""
        b, t, _ = self.votes.shape
        at = np.where(self.labelled, np.arange(t)[None, :], -1)
        at = np.maximum.accumulate(at, 1)
        at = np.where(at < 0, self.labelled.argmax(1)[:, None], at)
        return np.take_along_axis(self.votes.argmax(2), at, 1)


def fit(entries: list, rounds: int = 60, rate: float = 0.5, margin: float = 1.0) -> np.ndarray:
    """Weights with which the known turns score better than any other by a margin for each segment that is
    given to a wrong speaker (subgradient descent on the structured hinge loss)."""
    w = START.copy()
    entries = [rows for rows in entries if rows and all(len(r[2]) <= 1 for r in rows)]
    if not entries:
        return w
    lanes = Lanes(entries)
    gold = lanes.ruled()
    aim, wrong = lanes.features(gold), margin * (np.arange(lanes.votes.shape[2])[None, None, :] != gold[:, :, None])
    for n in range(rounds):
        found = lanes.best(w, wrong)
        step = (aim - lanes.features(found)) / len(entries)
        if not step.any():
            break
        w = w + rate * step
    return w


def segment_turns(entries: list, w: np.ndarray, lanes: int = 512) -> list[list[tuple[str, int, int]]]:
    """Turns (speaker, first, last) of each entry, a list of segments (start, end, votes, words) in order."""
    out: list = [[] for _ in entries]
    order = sorted((i for i, rows in enumerate(entries) if rows), key=lambda i: len(entries[i]))
    for b in range(0, len(order), lanes):
        part = order[b : b + lanes]
        side = Lanes([entries[i] for i in part])
        who = side.best(w)
        for k, i in enumerate(part):
            n = int(side.size[k])
            cuts = [0, *(np.nonzero(np.diff(who[k, :n]))[0] + 1).tolist(), n]
            out[i] = [(side.speakers[k][who[k, a]], a, z - 1) for a, z in zip(cuts, cuts[1:])]
    return out


def read_entry(starts: list, ends: list, names: list, texts: list) -> list[tuple[float, float, dict[str, float], list[str]]]:
    """Segments with speech in order of start: (start, end, votes for speakers, words)."""
    own = frozenset(x for n in names if (x := label(n)) and not x.startswith("speaker_"))
    seen: dict[tuple[float, float], tuple[dict[str, int], list[str]]] = {}
    for start, end, name, text in zip(starts, ends, names, texts):
        if start is None or not math.isfinite(start):
            continue
        words, found = speech(text, own)
        if not words:
            continue
        who, key = label(name) or found, (start, end if end is not None and math.isfinite(end) else -math.inf)
        if key not in seen:
            seen[key] = ({who: 1} if who else {}, words)
        elif who:
            votes, before = seen[key]
            seen[key] = (votes | {who: votes.get(who, 0) + 1}, before if votes else words)
    return [(*key, {k: v / sum(votes.values()) for k, v in votes.items()}, words) for key, (votes, words) in sorted(seen.items(), key=lambda x: x[0])]


def _read(column: pa.ListArray) -> list:
    """The entries of a batch, from its lists of segments."""
    flat = column.flatten()
    start, end, speaker, text = (flat.field(n).to_pylist() for n in ("start", "end", "speaker", "text"))
    gone = flat.is_valid().to_pylist()
    sizes = column.value_lengths().fill_null(0).to_pylist()
    out, at = [], 0
    for n in sizes:
        keep = [i for i in range(at, at + n) if gone[i]]
        out.append(read_entry(*([c[i] for i in keep] for c in (start, end, speaker, text))))
        at += n
    return out


def _turns(weights: np.ndarray, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = _read(batch.column(1))
            rows, cells = [], []
            for r, (segments, found) in enumerate(zip(entries, segment_turns(entries, weights))):
                for no, (who, a, z) in enumerate(found, 1):
                    part = segments[a : z + 1]
                    rows.append(r)
                    text = " ".join(w for s in part for w in s[3]) if with_text else None
                    cells.append((no, who, round(part[0][0] * 1000), round(max(max(s[1] for s in part), part[0][0]) * 1000), sum(len(s[3]) for s in part), text))
            columns = list(zip(*cells)) if cells else [[]] * 6
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["id", "turn_no", "speaker", "start_ms", "end_ms", "n_words", "text"])

    return run


def turns(entries: DataFrame, id_col: str = "audio_filepath", segments_col: str = "segments", with_text: bool = True, train_entries: int = 100, broadcast_ids: int = 200_000) -> DataFrame:
    """(id, turn_no, speaker, start_ms, end_ms, n_words, text) of every entry."""
    slim = entries.select(F.col(id_col).alias("id"), F.transform(segments_col, lambda s: F.when(s.isNotNull(), F.struct(s["text"].alias("text"), s["start"].cast("double").alias("start"), s["end"].cast("double").alias("end"), s["speaker"].alias("speaker")))).alias("segments"))
    slim = slim.where("id IS NOT NULL AND segments IS NOT NULL")
    several = staged(slim.groupBy("id").count().where("count > 1").select("id"))
    chosen = slim.where(F.size("segments") <= 2000).select("id", F.xxhash64("id").alias("h")).orderBy("h", "id").limit(train_entries)
    sample = slim.where(F.size("segments") <= 2000).join(F.broadcast(chosen.select("id").distinct()), "id", "left_semi").select("segments").limit(2 * train_entries).toArrow()
    weights = fit(_read(sample.column(0).combine_chunks())) if sample.num_rows else START
    if several.limit(broadcast_ids + 1).count() <= broadcast_ids:
        several = F.broadcast(several)
    single = slim.join(several, "id", "left_anti")
    merged = slim.join(several, "id", "left_semi").dropDuplicates().groupBy("id").agg(F.flatten(F.collect_list("segments")).alias("segments"))
    schema = f"id {slim.schema['id'].dataType.simpleString()}, turn_no long, speaker string, start_ms long, end_ms long, n_words long, text string"
    return single.mapInArrow(_turns(weights, with_text), schema).unionByName(merged.mapInArrow(_turns(weights, with_text), schema))
