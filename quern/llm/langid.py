"""Language identification: unigram piece models per language, every segmentation summed.

The vocabulary is a fixed public one (its path is a parameter): pieces, with a mark for the start of a word. A language is a
distribution over pieces. A word's probability is the sum over all of its segmentations of the product of its
pieces' probabilities, by the forward algorithm; a text's is the product over its words. Distributions are
learned by expectation-maximisation (forward-backward over the same lattices), from word counts of a bounded
sample: TRAIN_DOCS labelled rows per language, those with the smallest hashes of their ids, and of their blank-separated strings the TRAIN_STRINGS most frequent
of up to STRING_CHARS characters. Those bounds are the only ones; every text is scored whole.

A word is a run of letters, lower-cased; runs of over WORD_CHARS letters are scored in parts. Words are looked up by
the blank-separated strings they came in, so each is segmented once per worker (up to CACHED strings are kept).

A text that is null or has no letter is ``und`` with score 0, as is everything if no labelled rows exist. A
score is the posterior of the best language, all languages being equally likely beforehand; ties go to the
language that sorts first. A row with a null id is scored and counts as held out. Repeated rows are scored alike. Other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm._shared import per_process, stored

TRAIN_DOCS = 300
TRAIN_STRINGS = 200_000
STRING_CHARS = 200
OVERSAMPLE = 8
ROUNDS = 4
WORD_CHARS = 40
CACHED = 600_000
UNKNOWN = 1e-6  # of a letter that no piece covers, in every language
SMOOTHING = 0.02  # pseudo-count of each piece
UND = "und"
#: What ``filter_language`` asks for by default.
MIN_SCORE = 0.3
MIN_FIT = -4.0
ALPHABET = 26
WORD_FIT = 10.0
_LETTERS = re.compile(r"[^\W\d_]+")
_START = "▁"


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def pieces(path: str) -> dict[str, int]:
    """Pieces that can be part of a word, by their place in the vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {}
    for i in range(model.vocab_size()):
        p = model.id_to_piece(i)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and (p == _START or _LETTERS.fullmatch(p.removeprefix(_START))):
            found.setdefault(p.lower(), len(found))
    return found


def beginnings(known: dict[str, int]) -> dict[str, int]:
    """Every beginning of a piece: the piece's number if it is one itself, else -1. The empty string has the number of what no piece covers."""
    out = {p[:n]: -1 for p in known for n in range(1, len(p))}
    return out | known | {"": len(known)}


class Lattice:
    """Segmentations of many words: arcs (word, start, end, piece), sorted by end and word."""

    def __init__(self, words: list[str], starts: dict[str, int]):
        unknown = starts[""]
        arcs = []  # end, word, start and piece in one number, which sorts by end and word
        get, add = starts.get, arcs.append
        for k, w in enumerate(words):
            n, word = len(w), k << 26
            for i in range(n):
                base = word | i << 20
                bare = True
                for j in range(i + 1, n + 1):
                    p = get(w[i:j])
                    if p is None:  # no piece goes on like this
                        break
                    if p >= 0:
                        bare = bare and j > i + 1
                        add(j << 50 | base | p)
                if bare:
                    add(i + 1 << 50 | base | unknown)
        self.n, self.sizes = len(words), np.fromiter(map(len, words), np.int64, len(words))
        self.width = int(self.sizes.max(initial=0)) + 1
        arcs = np.sort(np.array(arcs, np.int64))
        self.end, self.at, self.begin, self.piece = arcs >> 50, arcs >> 26 & 0xFFFFFF, arcs >> 20 & 63, arcs & 0xFFFFF
        self.cuts = np.searchsorted(self.end, np.arange(1, self.width + 1))

    def forward(self, prob: np.ndarray) -> np.ndarray:
        """Sums over all segmentations of each prefix: (words, width, languages). prob: (pieces + 1, languages)."""
        alpha = np.zeros((self.n, self.width, prob.shape[1]))
        alpha[:, 0] = 1
        for j in range(1, self.width):
            a, b = self.cuts[j - 1], self.cuts[j]
            if a == b:
                continue
            gain = alpha[self.at[a:b], self.begin[a:b]] * prob[self.piece[a:b]]
            heads = np.flatnonzero(np.diff(self.at[a:b], prepend=-1))
            alpha[self.at[a:b][heads], j] = np.add.reduceat(gain, heads, axis=0)
        return alpha

    def totals(self, prob: np.ndarray) -> np.ndarray:
        """Log-probability of each word in each language."""
        if not self.n:
            return np.zeros((0, prob.shape[1]))
        return np.log(self.forward(prob)[np.arange(self.n), self.sizes] + 1e-300)

    def expected(self, prob: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece in one language. prob: (pieces + 1, 1)."""
        alpha = self.forward(prob)[:, :, 0]
        whole = alpha[np.arange(self.n), self.sizes]
        beta = np.zeros((self.n, self.width))
        beta[np.arange(self.n), self.sizes] = 1
        p = prob[self.piece, 0]
        for j in range(self.width - 1, 0, -1):
            a, b = self.cuts[j - 1], self.cuts[j]
            np.add.at(beta, (self.at[a:b], self.begin[a:b]), p[a:b] * beta[self.at[a:b], j])
        use = alpha[self.at, self.begin] * p * beta[self.at, self.end] / whole[self.at] * counts[self.at]
        return np.bincount(self.piece, use, minlength=len(prob))


def words_of(string: str) -> list[str]:
    """The words of a blank-separated string, marked at their start."""
    out = []
    for w in _LETTERS.findall(string.lower()):
        marked = _START + w
        out += [marked[i : i + WORD_CHARS] for i in range(0, len(marked), WORD_CHARS)]
    return out


def _normal(expected: np.ndarray) -> np.ndarray:
    p = expected[:-1] + SMOOTHING
    return np.append(p / p.sum(), UNKNOWN)


def learn(counts: dict[str, dict[str, int]], known: dict[str, int], rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """counts: language to string to number. Languages in order, and piece probabilities (pieces + 1, languages)."""
    starts = beginnings(known)
    langs, columns = sorted(counts), []
    for lang in langs:
        total: dict[str, int] = {}
        for string, n in counts[lang].items():
            for w in words_of(string):
                total[w] = total.get(w, 0) + n
        words = sorted(total)
        lattice, weight = Lattice(words, starts), np.array([total[w] for w in words], float)
        prob = _normal(np.bincount(lattice.piece, weight[lattice.at], minlength=len(known) + 1))
        for _ in range(rounds):
            prob = _normal(lattice.expected(prob[:, None], weight))
        columns.append(prob)
    return langs, np.stack(columns, axis=1) if columns else np.zeros((len(known) + 1, 0))


def held_out(id_col: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(3)) == 1, F.lit(True))


def training_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, train_docs: int) -> DataFrame:
    """lang, text of the sample: per language the train_docs rows with the smallest hashes of their ids (ties: by text), equal rows once.

    Counts per language say below which hash about OVERSAMPLE times as many lie; only those are ranked, so the ranking's task per language gets no more the more rows
    there are. Should fewer be found (an id that fills a language's rows), the bound is raised until it no longer binds.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    rows = rows.filter(F.col("lang").isNotNull() & ~held_out("id")).withColumn("h", F.xxhash64("id"))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    rows = rows.filter(F.col("text").isNotNull())
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "id", "t"))
    share = {lang: OVERSAMPLE * train_docs / n for lang, n in counts.items()}
    while True:
        bounds = [F.when(F.col("lang") == lang, F.lit(int(-(2**63) + s * 2**64))) for lang, s in share.items() if s < 1]
        below = (F.col("h") < F.coalesce(*bounds)) | F.coalesce(*bounds).isNull() if bounds else F.lit(True)
        keys = rows.filter(below).select("lang", "h", "id", F.xxhash64("text").alias("t")).distinct()
        chosen = stored(keys.withColumn("rank", rank).filter(F.col("rank") <= train_docs).drop("rank"), "langid-sample")
        found = {r["lang"]: r["count"] for r in chosen.groupBy("lang").count().collect()}
        short = [lang for lang, s in share.items() if s < 1 and found.get(lang, 0) < train_docs]
        if not short:
            break
        share |= {lang: share[lang] * 16 for lang in short}
    picked = rows.withColumn("t", F.xxhash64("text")).join(F.broadcast(chosen.select("lang", "id", "t")), ["id", "lang", "t"])
    return picked.dropDuplicates(["lang", "id", "t"]).select("lang", "text")


def training_counts(docs: DataFrame, id_col: str, text_col: str, lang_col: str, train_docs: int) -> dict[str, dict[str, int]]:
    """Counts of blank-separated strings per language, of the sample: the TRAIN_STRINGS most frequent of up to STRING_CHARS characters, so that what comes to
    the driver is bounded in bytes as well."""
    chosen = training_rows(docs, id_col, text_col, lang_col, train_docs)
    strings = chosen.select("lang", F.explode(F.split(F.lower("text"), r"\s+")).alias("s")).filter(F.length("s") <= STRING_CHARS)
    counted = strings.groupBy("lang", "s").count()
    most = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "s"))
    out: dict[str, dict[str, int]] = {}
    for lang, s, n in counted.withColumn("place", most).filter(F.col("place") <= TRAIN_STRINGS).drop("place").orderBy("lang", "s").collect():
        out.setdefault(lang, {})[s] = n
    return out


class Scorer:
    """Sums of word log-probabilities, words kept by the strings they came in."""

    def __init__(self, known: dict[str, int], prob: np.ndarray):
        self.starts, self.prob = beginnings(known), prob
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.words: dict[str, int] = {}
        width = self.prob.shape[1] + 2  # the last columns are the words' fit and their number
        self.rows, self.values = np.zeros((1 << 12, width)), np.zeros((1 << 12, width))

    @staticmethod
    def _room(rows: np.ndarray, n: int) -> np.ndarray:
        if n > len(rows):  # by a half, in place where the allocator can
            rows.resize((max(n, len(rows) * 3 // 2), rows.shape[1]), refcheck=False)
        return rows

    def learn_strings(self, strings: list[str]) -> None:
        words, known = self.words, len(self.words)
        parts = [[words.setdefault(w, len(words)) for w in words_of(s)] for s in strings]
        if len(words) > known:
            new = list(words)[known:]
            self.values = self._room(self.values, len(words))
            totals = Lattice(new, self.starts).totals(self.prob)
            self.values[known : len(words), :-2] = totals
            letters = np.fromiter(map(len, new), np.int64, len(new))  # the mark at the start stands for the end
            self.values[known : len(words), -2] = np.clip(totals.max(axis=1, initial=-np.inf) + letters * np.log(ALPHABET + 1), -WORD_FIT, WORD_FIT)
            self.values[known : len(words), -1] = 1
        base = len(self.index)
        self.rows = self._room(self.rows, base + len(strings))
        self.index.update(zip(strings, range(base, base + len(strings))))
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        full = np.flatnonzero(sizes)
        if len(full):
            flat = np.array([w for own in parts for w in own], np.int64)
            heads = np.cumsum(sizes)[full] - sizes[full]
            self.rows[base + full] = np.add.reduceat(self.values[flat], heads, axis=0)

    def score(self, texts: list[str | None]) -> list[np.ndarray]:
        """For each text: log-probability per language, then the sum of its words' fits and the number of words."""
        split = [(t or "").split() for t in texts]
        if len(self.index) > CACHED:
            self.clear()
        index = self.index
        missing = list({s for strings in split for s in strings if s not in index})
        for k in range(0, len(missing), 8192):
            self.learn_strings(missing[k : k + 8192])
        get = index.__getitem__
        return [self.rows[np.fromiter(map(get, s), np.int64, len(s))].sum(axis=0) for s in split]


def train(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_docs: int = TRAIN_DOCS):
    """(languages, probabilities, vocabulary)."""
    known = pieces(path or vocabulary_path())
    langs, prob = learn(training_counts(docs, id_col, text_col, lang_col, train_docs), known)
    return langs, prob, known


def add_language(docs: DataFrame, model, text_col: str = "text", pred_col: str = "lang_pred", score_col: str = "score", fit_col: str = "fit") -> DataFrame:
    """docs as ``row`` (a struct of all columns, whatever their names), then three columns: the prediction, its score, and how much likelier
    its words are in a learned language than as letters at random (the mean over words in nats, each of ALPHABET letters and a word's end being equally likely, and
    no word counting for more than WORD_FIT either way, so that a key or a hash amid prose doesn't outweigh it; 0 for ``und``)."""
    chosen = docs.select(F.struct("*").alias("row"), F.col(text_col).cast("string").alias("text"))
    return _told(chosen, model, pred_col, score_col, fit_col)


def _told(chosen: DataFrame, model, pred_col: str, score_col: str, fit_col: str) -> DataFrame:
    """chosen: row, text. row and the three columns."""
    import pyarrow as pa

    langs, prob, known = model
    names = list(known)
    key = f"langid-{hash((prob.tobytes(), tuple(names)))}"

    def run(batches):
        scorer = per_process(key, lambda: Scorer({p: i for i, p in enumerate(names)}, prob))
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                labels, scores, fits = [], [], []
                for row in scorer.score(part.column(1).to_pylist()):
                    if not langs or not row[-1]:
                        labels.append(UND)
                        scores.append(0.0)
                        fits.append(0.0)
                        continue
                    best = int(np.argmax(row[:-2]))
                    labels.append(langs[best])
                    scores.append(float(1 / np.exp(row[:-2] - row[best]).sum()))
                    fits.append(float(row[-2] / row[-1]))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(labels, pa.string()), pa.array(scores, pa.float64()), pa.array(fits, pa.float64())], schema=pa.schema([part.schema.field(0), (pred_col, pa.string()), (score_col, pa.float64()), (fit_col, pa.float64())]))

    schema = chosen.select("row", F.lit("").alias(pred_col), F.lit(0.0).alias(score_col), F.lit(0.0).alias(fit_col)).schema
    return chosen.mapInArrow(run, schema)


def filter_language(docs: DataFrame, model, languages: list[str] | None = None, min_score: float = MIN_SCORE, min_fit: float = MIN_FIT, text_col: str = "text") -> DataFrame:
    """docs (all columns) whose language is told: of the languages wanted (None: any that was learned), with a score of at least min_score, and a text whose words fit
    (at least min_fit, see ``add_language``), which letters at random don't. Texts without a letter go. With no language learned, all
    others stay: nothing can be told of them."""
    if not model[0]:
        return docs.filter(F.coalesce(F.col(text_col).cast("string").rlike(r"\p{L}"), F.lit(False)))
    told = add_language(docs, model, text_col, "p", "s", "f")
    kept = told.filter((F.col("p") != UND) & (F.col("s") >= min_score) & (F.col("f") >= min_fit))
    if languages is not None:
        kept = kept.filter(F.col("p").isin(languages))
    return kept.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def predict(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, lang_pred, score, fit. Only the text is read for a prediction."""
    chosen = docs.select(F.struct(F.col(id_col).alias("id")).alias("row"), F.col(text_col).cast("string").alias("text"))
    told = _told(chosen, model, "lang_pred", "score", "fit")
    return told.select(F.col("row.id").alias(id_col), held_out("row.id").alias("held_out"), "lang_pred", "score", "fit")
