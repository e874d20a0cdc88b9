"""Toxicity: Levenshtein automata over a lexicon trie, weighed by the words around a hit."""

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.llm.frame import col, pack, short_batches, unpack
from vigilog.storage import materialize

EDGE = " \t\r\n\v\f.,;:!?\"'()[]{}<>«»“”„‘’…#%&*+/=|\\^_`~-"
TRIPLED = re.compile(r"(\w)\1{2,}")
QUOTES = re.compile("[\"“”„«»‹›]")
LETTER = re.compile(r"\w")
# Words that report another's words, and words that address the reader.
REPORTING = frozenset(
    "said says say called calls wrote quote quoted word words term insult insults phrase slur sagte nannte schrieb wort "
    "zitat dit appelle mot terme cita dijo llama palabra".split()
)
ADDRESSING = frozenset("you your you're youre u ur du dich dein deine ihr euch tu toi ton te vous usted eres".split())
NEAR = 6
WINDOW = 64
PREFIXES = range(4, 11)
KNOWN_WORDS = 150_000
KNOWN_STEPS = 500_000
COUNTED_AT_ONCE = 100_000


class Lexicon:
    """A trie of terms and the automaton that accepts words within a term's edit allowance.

    States are sets of (node, edits, awaited letter). One edit is an insertion, a deletion,
    a substitution or a swap of neighbours. State sets are built when first met and kept,
    so that a word costs one dictionary step for each letter until no term is near; beyond
    ``KNOWN_STEPS`` kept steps they are built anew. An open term accepts every word that begins with it.
    """

    def __init__(self, terms: dict[str, bool]):
        """``terms``: the terms, and whether each is open."""
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.term_at: list[str | None] = [None]
        self.most = [0]
        for term in sorted(terms):
            node, allowed = 0, self.allowance(term, terms[term])
            self.most[0] = max(self.most[0], allowed)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term_at.append(None)
                    self.most.append(0)
                node = self.children[node][letter]
                self.most[node] = max(self.most[node], allowed)
            self.term_at[node] = term
        self._forget()

    def _forget(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.kept = 0
        self.start = self._state(self._closed({(0, 0, "")}))

    @staticmethod
    def allowance(term: str, is_open: bool) -> int:
        if is_open:
            return int(len(term) >= 7)
        return 0 if len(term) < 4 else 1 if len(term) < 8 else 2

    def _closed(self, found: set) -> frozenset:
        """With what is reached by leaving out letters of a term."""
        open_, all_ = list(found), set(found)
        while open_:
            node, edits, awaited = open_.pop()
            if awaited:
                continue
            for child in self.children[node].values():
                if edits < self.most[child] and (child, edits + 1, "") not in all_:
                    all_.add((child, edits + 1, ""))
                    open_.append((child, edits + 1, ""))
        return frozenset(all_)

    def _state(self, found: frozenset) -> int:
        if found not in self.states:
            self.states[found] = len(self.sets)
            self.sets.append(found)
            self.steps.append({})
        return self.states[found]

    def _step(self, state: int, letter: str) -> int:
        found = set()
        for node, edits, awaited in self.sets[state]:
            if awaited:
                if letter == awaited:
                    found.add((node, edits, ""))
                continue
            below = self.children[node]
            if letter in below:
                found.add((below[letter], edits, ""))
            if edits < self.most[node]:
                found.add((node, edits + 1, ""))
            for other, child in below.items():
                if edits < self.most[child]:
                    found.add((child, edits + 1, ""))
                    swapped = self.children[child].get(letter)
                    if other != letter and swapped is not None and edits < self.most[swapped]:
                        found.add((swapped, edits + 1, other))
        target = self._state(self._closed(found))
        self.steps[state][letter] = target
        self.kept += 1
        return target

    def _accepted(self, state: int, whole: bool) -> list[tuple[int, int, str]]:
        return [
            (edits, -len(t), t) for node, edits, awaited in self.sets[state]
            if not awaited and (t := self.term_at[node]) and edits <= self.allowance(t, self.terms[t]) and (whole or self.terms[t])
        ]

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its edits, ties to the longest; None if no term is near."""
        if self.kept > KNOWN_STEPS:
            self._forget()
        state, found = self.start, []
        for letter in word:
            target = self.steps[state].get(letter)
            state = self._step(state, letter) if target is None else target
            if not self.sets[state]:
                break
            found += self._accepted(state, False)
        else:
            found += self._accepted(state, True)
        if not found:
            return None
        edits, _, term = min(found)
        return term, edits


def stripped(word: str) -> str:
    word = word.strip(EDGE)
    return TRIPLED.sub(r"\1", word) if TRIPLED.search(word) else word


def _words(text: str) -> Counter:
    return Counter(stripped(w) for w in text.lower().split())


def _counted(text: str, asked: frozenset | None = None) -> Counter:
    """Candidates of a text: its words of 3 to 30 letters (marked by a final blank) and the first letters of all its words.

    Longer words are known by their beginnings alone, so no term of the lexicon is longer.
    """
    found: Counter = Counter()
    for word, n in _words(text).items():
        for t in (*[word[:k] for k in PREFIXES if len(word) >= k], *([f"{word} "] if 3 <= len(word) <= 30 else [])):
            if asked is None or t in asked:
                found[t] += n
    return found


def beyond_chance(clean: int, toxic: int, rows: tuple[int, int]) -> float:
    """How unlikely it is that so many of a candidate's rows are toxic by chance: minus the log of Chernoff's bound."""
    chance, share = (rows[1] + 1) / (rows[0] + rows[1] + 2), toxic / max(1, clean + toxic)
    if share <= chance:
        return 0.0
    return toxic * math.log(share / chance) + (clean * math.log((1 - share) / (1 - chance)) if clean else 0.0)


def least_rows(rows: tuple[int, int], tried: int) -> int:
    """The number of rows from which on a candidate of toxic rows only is no chance find among ``tried``."""
    return max(3, math.ceil(math.log(tried + 1) / beyond_chance(0, 1, rows)))


def sure_terms(toxic: dict, clean: dict, words: tuple[int, int], rows: tuple[int, int], ratio: float, tried: int) -> dict[str, float]:
    """Candidates at least ``ratio`` times as frequent in toxic rows, in more of them than chance explains.

    ``toxic`` and ``clean`` hold (occurrences, rows) by candidate, ``tried`` is the number of
    candidates met. No share of the toxic rows is asked for, so rare terms are found in large
    samples too. Of a chain of ever longer beginnings those stay that the next letter would
    split. Returns the log of the ratio.
    """
    bar = math.log(tried + 1)
    longer: dict[str, int] = defaultdict(int)
    for t, (_, n) in toxic.items():
        if not t.endswith(" "):
            longer[t[:-1]] = max(longer[t[:-1]], n)
    logs = {t: log_ratio(clean.get(t, (0, 0))[0], n, words) for t, (n, _) in toxic.items()}
    return {
        t: logs[t] for t, (_, n) in toxic.items()
        if n >= 3 and beyond_chance(clean.get(t, (0, 0))[1], n, rows) >= bar and logs[t] >= math.log(ratio) and (t.endswith(" ") or longer[t] < 0.9 * n)
    }


def log_ratio(clean: float, toxic: float, words: tuple[int, int]) -> float:
    return math.log((toxic + 0.5) / (words[1] + 1)) - math.log((clean + 0.5) / (words[0] + 1))


def select_terms(sure: dict[str, float], rows: list[list[str]], toxic: dict, least: float) -> dict[str, bool]:
    """The lexicon, and whether each term is open.

    Terms are taken by the toxic rows that they alone explain so far, times how telling they
    are; words that only ride along in such rows explain nothing more. The rows are distinct
    texts, so the words of a text with many copies have no more rows than those of any other.
    A term in at least 0.4 as many rows as the taken term it shares most rows with is a term
    of its own right. Beginnings stand for their longer forms. A term whose rows mostly hold
    it as a whole word is closed.
    """
    held: dict[str, set[int]] = defaultdict(set)
    for i, terms in enumerate(rows):
        for t in terms:
            held[t].add(i)
    left, taken = {t: set(h) for t, h in held.items()}, []
    while left := {t: h for t, h in left.items() if len(h) >= least}:
        best = max(left, key=lambda t: (len(left[t]) * sure[t], -len(t), t))
        taken.append(best)
        covered = left.pop(best)
        left = {t: h - covered for t, h in left.items()}
    chosen = list(taken)
    for t in sorted(held, key=lambda t: (-len(held[t]), t)):
        near = max(taken, key=lambda x: len(held[x] & held[t]), default=None)
        if t not in chosen and near and len(held[t]) >= 0.4 * len(held[near]):
            chosen.append(t)
    kept: dict[str, bool] = {}
    for t in sorted(chosen, key=lambda t: (len(t.strip()), not t.endswith(" "), t)):
        word = t.strip()
        if word in kept or any(kept.get(word[:k]) for k in range(1, len(word))):
            continue
        kept[word] = not t.endswith(" ") and toxic.get(f"{word} ", (0, 0))[1] < 0.5 * toxic[t][1]
    return kept


def fitted(values: list[float], labels: list[int]) -> tuple[float, float]:
    """Slope and intercept of a logistic curve through evidence and label.

    Newton's method with bounded steps; a weak pull to slope 1 and intercept -4 keeps
    the curve finite where labels can be told apart without error.
    """
    x, y = np.array(values, float), np.array(labels, float)
    design = np.stack([x, np.ones_like(x)], axis=1)
    prior, pull = np.array([1.0, -4.0]), np.array([4.0, 0.5])
    w = prior.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + pull * (w - prior)
        curve = (design * (p * (1 - p))[:, None]).T @ design + np.diag(pull)
        w = w - np.clip(np.linalg.solve(curve, gradient), -0.5, 0.5)
    return float(w[0]), float(w[1])


def learn(rows: DataFrame, text: str, label: str, ratio: float = 8.0) -> dict:
    """Learns from labelled rows: the lexicon, a weight for each form of its terms, the curve from evidence to score.

    ``rows`` is a bounded sample (see ``labelled``), of which each distinct text counts once;
    of several labels of a text the mean decides. Candidates are counted in toxic rows,
    then those with enough support in clean rows, then the forms of the chosen terms in all
    rows, exact and near. These counts, the candidates of each toxic row and the evidence of
    each row are all that reaches the driver.
    """
    short_batches(rows.sparkSession)
    texts = rows.select(F.coalesce(col(text), F.lit("")).alias("text"), col(label).cast("int").alias("label"))
    rows = materialize(texts.groupBy("text").agg((F.avg("label") >= 0.5).cast("int").alias("label")).where("label is not null"), "labelled")
    n = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    sizes = (n.get(0, 0), n.get(1, 0))
    if not all(sizes):
        return {"terms": {}, "weights": {}, "curve": (1.0, -5.0), "rows": sum(sizes)}

    def counted(part: DataFrame, asked: frozenset | None) -> DataFrame:
        def count(frames):
            total: dict[str, list[int]] = defaultdict(lambda: [0, 0])

            def counts():
                return pd.DataFrame({"term": pd.Series(list(total), dtype=object), "n": [v[0] for v in total.values()], "d": [v[1] for v in total.values()]})

            for pdf in frames:
                for t in pdf["text"]:
                    total[""][0] += len(t.split())
                    for term, n in _counted(t, asked).items():
                        total[term][0] += n
                        total[term][1] += 1
                    if len(total) > COUNTED_AT_ONCE:
                        yield counts()
                        total.clear()
            yield counts()

        return part.mapInPandas(count, "term string, n long, d long").groupBy("term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))

    candidates = materialize(counted(rows.where("label = 1"), None), "candidates")
    # All that were met, also those too rare to be chosen: the more are tried, the more chance finds.
    tried = candidates.where("term <> ''").count()
    least = least_rows(sizes, tried)
    toxic = {r.term: (r.n, r.d) for r in candidates.where((F.col("d") >= least) | (F.col("term") == "")).collect()}
    clean = {r.term: (r.n, r.d) for r in counted(rows.where("label = 0"), frozenset(toxic)).collect()}
    words = (clean.pop("", (0, 0))[0], toxic.pop("", (0, 0))[0])
    sure = sure_terms(toxic, clean, words, sizes, ratio, tried)
    chosen = frozenset(sure)

    def holding(frames):
        for pdf in frames:
            yield pd.DataFrame({"terms": [sorted(_counted(t, chosen)) for t in pdf["text"]]})

    held = [list(r.terms) for r in rows.where("label = 1").mapInPandas(holding, "terms array<string>").collect()]
    terms = select_terms(sure, held, toxic, least)

    def forms(frames):
        lexicon, seen, total = Lexicon(terms), {}, Counter()
        for pdf in frames:
            for t, y in zip(pdf["text"], pdf["label"]):
                for w, n in _words(t).items():
                    if w not in seen:
                        seen[w] = form_of(lexicon, w)
                    if seen[w]:
                        total[(*seen[w], y)] += n
        yield pd.DataFrame([(*k, v) for k, v in total.items()], columns=["term", "form", "label", "n"]).astype({"term": object, "form": object})

    found: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0])
    for r in rows.mapInPandas(forms, "term string, form string, label int, n long").groupBy("term", "form", "label").agg(F.sum("n").alias("n")).collect():
        found[(r.term, r.form)][r.label] += r.n
    weights = weighed(found, words)
    model = {"terms": terms, "weights": weights, "curve": (1.0, 0.0), "rows": sum(sizes)}

    def evidence(frames):
        judge = Judge(model)
        for pdf in frames:
            yield pd.DataFrame({"x": [judge.evidence(t)[0] for t in pdf["text"]], "y": pdf["label"].to_numpy()})

    points = rows.mapInPandas(evidence, "x double, y int").toPandas()
    return model | {"curve": fitted(points["x"].tolist(), points["y"].tolist())}


def form_of(lexicon: Lexicon, word: str) -> tuple[str, str] | None:
    """(term, form): exact forms are named by the sign after the term, near ones by ``~`` and the word."""
    found = lexicon.match(word)
    if found is None:
        return None
    term, edits = found
    return (term, f"~{word}") if edits else (term, word[len(term) : len(term) + 1] or " ")


def weighed(found: dict[tuple[str, str], list[int]], words: tuple[int, int]) -> dict[tuple[str, str], float]:
    """Log ratios by form; ``(term, "")`` for a rare exact form and ``(term, "~")`` for a near form not met.

    Near forms not met weigh less the more near forms clean rows hold: then the term lies
    among ordinary words.
    """
    exact, near = defaultdict(lambda: [0, 0]), defaultdict(int)
    for (term, form), (clean, toxic) in found.items():
        if form[0] != "~":
            exact[term][0] += clean
            exact[term][1] += toxic
        elif clean:
            near[term] += 1
    weights = {}
    for term, (clean, toxic) in exact.items():
        weights[(term, "")] = max(0.0, log_ratio(clean, toxic, words))
        weights[(term, "~")] = 0.8 * weights[(term, "")] / (1 + near[term] / 3)
    for (term, form), (clean, toxic) in found.items():
        own, cap = log_ratio(clean, toxic, words), weights.get((term, "~" if form[0] == "~" else ""), 0.0)
        if form[0] == "~":
            weights[(term, form)] = max(0.0, min(own, cap)) if clean else cap
        elif clean + toxic >= 5:
            weights[(term, form)] = max(0.0, own)
    return weights


class Judge:
    """Scores texts with what ``learn`` found."""

    def __init__(self, model: dict):
        self.model, self.lexicon = model, Lexicon(model["terms"])
        self.hits: dict[str, float] = {}
        self.clean: set[str] = set()

    def _weight(self, raw: str) -> float:
        if raw not in self.hits:
            found = form_of(self.lexicon, stripped(raw))
            weights = self.model["weights"]
            weight = 0.0
            if found is not None:
                weight = weights.get(found, weights.get((found[0], "~" if found[1][0] == "~" else ""), 0.0))
            if weight <= 0:
                self.clean.add(raw)
                return 0.0
            self.hits[raw] = weight
        return self.hits[raw]

    @staticmethod
    def context(words: list[str], at: int, quoted: bool) -> float:
        """How far a hit is abuse (1) and not mention: quoted or reported words count less, address counts fully."""
        around = {w.strip(EDGE) for w in words[max(0, at - NEAR) : at] + words[at + 1 : at + 1 + NEAR]}
        if quoted:
            return 0.45
        return 1.0 if around & ADDRESSING else 0.7 if around & REPORTING else 1.0

    @staticmethod
    def quoted(words: list[str]) -> set[int]:
        """The places of words between an opening and a closing sign less than ``WINDOW`` words apart.

        A sign before the letters of its word opens, one behind them closes, any other does
        what is due. The nearest opening sign counts, and signs without a partner do nothing.
        """
        places: set[int] = set()
        opened = None
        for at, raw in enumerate(words):
            if not QUOTES.search(raw):
                continue
            letters = [m.start() for m in LETTER.finditer(raw)]
            for m in QUOTES.finditer(raw):
                before, after = bool(letters) and letters[0] < m.start(), bool(letters) and letters[-1] > m.start()
                due = opened is not None and at - opened < WINDOW
                if due and (before or not after):
                    places.update(range(opened, at + 1))
                    opened = None
                elif after or not before:
                    opened = at
        return places

    def evidence(self, text: str) -> tuple[float, int]:
        """The weights of the hits in the heaviest window of ``WINDOW`` words, and the number of hits."""
        words = text.lower().split()
        if len(self.clean) + len(self.hits) > KNOWN_WORDS:
            self.clean.clear()
            self.hits.clear()
        near = {w for w in set(words).difference(self.clean) if self._weight(w)}
        if not near:
            return 0.0, 0
        quoted = self.quoted(words)
        places = [(at, self.hits[raw] * self.context(words, at, at in quoted)) for at, raw in enumerate(words) if raw in near]
        best = running = 0.0
        first = 0
        for at, weight in places:
            running += weight
            while at - places[first][0] >= WINDOW:
                running -= places[first][1]
                first += 1
            best = max(best, running)
        return best, len(places)

    def score(self, text: str) -> tuple[float, int]:
        """(score, number of hits) of a whole text; 0 without words."""
        found, hits = self.evidence(text)
        slope, level = self.model["curve"]
        if not found and not text.strip():
            return 0.0, 0
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, slope * found + level)))), hits


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample_rows: int = 20_000) -> DataFrame:
    """Texts with their labels: at most about ``sample_rows`` labelled rows, chosen by a hash of the key.

    That bound is the only one: it limits what the lexicon is learned from, never what is
    scored. Rows without label are left out; of several labels of a key the mean decides.
    """
    known = labels.where(col(label).isNotNull() & col(key).isNotNull()).groupBy(col(key).alias("_key")).agg((F.avg(col(label)) >= 0.5).cast("int").alias("_label"))
    share = min(1.0, sample_rows / max(1, known.count()))
    some = known.where(F.pmod(F.xxhash64("_key"), F.lit(1 << 30)) < share * (1 << 30))
    # The chosen labels are bounded by ``sample_rows``.
    return docs.select(col(key).alias("_key"), col(text).alias("_text")).join(F.broadcast(some), "_key").select("_text", "_label")


def with_scores(docs: DataFrame, model: dict, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """Adds ``score`` (0 to 1), ``hits`` and ``predicted`` (1 if score >= ``threshold``).

    Only the text is read, whole; null and blank texts score 0. A score depends on the
    text alone, so repeated rows agree. An empty table gives an empty result; a result
    replaces an input column of the same name. With no lexicon (no toxic label was seen)
    no text is predicted toxic.
    """
    short_batches(docs.sparkSession)
    judges: list[Judge] = []

    @F.pandas_udf("score double, hits int")
    def judge(texts: pd.Series) -> pd.DataFrame:
        if not judges:
            judges.append(Judge(model))
        return pd.DataFrame([judges[0].score(t or "") for t in texts], columns=["score", "hits"])

    judged = docs.select(pack(docs), judge(col(text).cast("string")).alias("_found"))
    score: Column = F.col("_found.score")
    return unpack(judged, docs.columns, {"score": score, "hits": F.col("_found.hits"), "predicted": (score >= threshold).cast("int")})
