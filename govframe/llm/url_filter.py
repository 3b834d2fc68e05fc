"""URL filter: host and path rules first, then a weighted vocabulary counted by Aho-Corasick.

One automaton holds the whole vocabulary and passes once over each url.  A term counts only
between boundaries (no ASCII letter or digit on either side) and once per url.  One strict term rejects
the url; so do ``min_soft`` distinct soft terms whose weights come to ``min_soft`` in sum.

A vocabulary is a table of term, kind (``strict`` or ``soft``) and weight.  ``PRODUCTION`` is composed by rule
from short word lists (see ``composed``); ``read_vocabulary`` takes any other from a DataFrame.  Its size is checked before it
is broadcast; each worker builds the automaton once.

Null url, or one without ``://``: host and path are empty, no rule fits, and the vocabulary is
searched in what text there is.  An empty table gives no rows.  Very long urls are searched whole, in one pass.  Of rules of
equal length the blocking one holds.  A term that is listed twice counts as strict if one entry is, and with its greater weight.
Repeated rows are judged one by one.  Nothing is shuffled, so a host that holds a third of the rows costs nothing extra.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govframe.llm.common import kept_in_worker, map_texts

#: Words of the production vocabulary.  A strict word rejects alone, also between any of ``BEFORE`` and ``AFTER``; phrases reject as they stand.
STRICT = tuple(
    "adult bdsm blowjob bukkake casino cialis creampie cumshot dildo erotic erotica escort fetish gangbang hardcore hentai hookup kamagra levitra lolicon milf "
    "nude onlyfans orgy phentermine poker porn porno pornstar roulette sexcam sexchat sexshop slots sportsbook striptease threesome tramadol viagra voyeur webcamsex xanax xxx xxxvideos".split()
)
PHRASES = ("casino-bonus", "cheap-meds", "free-spins", "live-sex", "no-prescription", "online-betting", "payday-loan", "sex-chat", "slot-machine", "work-from-home-cash")
BEFORE = tuple("best free gay hd hot live my new online real teen top video vip".split())
AFTER = tuple("24 24h 365 cam cams chat club free hd hub live online pics s site star tube tv video videos vip world x zone".split())
#: A soft word weighs 1, also before any of ``SOFT_AFTER``; a weak one 0.5, as it stands.
SOFT = tuple(
    "bet bingo bonus cam cash cheap clickbait credit crypto dating debt diet discount drugs forex free gamble girls gratis hot jackpot keygen loan lottery lotto "
    "meds mortgage nulled pharmacy pills promo refinance replica serial sex sexy singles slot spam spin steroid torrent wager warez webcam win".split()
)
SOFT_AFTER = tuple("24 365 deals now online s shop site store".split())
WEAK = tuple("amazing best bargain buy cracked deal earn exclusive extra fast instant limited lucky money offer order profit prize quick sale save top unlimited vip winner".split())


@dataclass(frozen=True)
class Term:
    """A text to look for, lower-cased (A-Z); ``weight`` is used of soft terms only."""

    text: str
    strict: bool
    weight: float = 1.0


def composed() -> tuple[Term, ...]:
    """The production vocabulary: about 16,000 terms, by the rules above."""
    out = [Term(b + w + a, True) for w in STRICT for b in ("", *BEFORE) for a in ("", *AFTER)]
    out += [Term(w, True) for w in PHRASES]
    out += [Term(w + a, False) for w in SOFT for a in ("", *SOFT_AFTER)]
    return (*out, *(Term(w, False, 0.5) for w in WEAK))


PRODUCTION = composed()
#: Bounds of a vocabulary that is broadcast.
MAX_TERMS, MAX_CHARS = 1_000_000, 32_000_000


def read_vocabulary(table: DataFrame) -> tuple[Term, ...]:
    """Terms of a table (term, kind, weight; a null weight is 1); rows without a term are left out.  A table beyond the bounds is an error."""
    rows = table.select(F.col("term").cast("string").alias("term"), F.col("kind").cast("string").alias("kind"), F.coalesce(F.col("weight").cast("double"), F.lit(1.0)).alias("weight"))
    rows = rows.filter("term <> ''")
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("term")), F.lit(0)).alias("chars"), F.count_if(F.coalesce(~F.col("kind").isin("strict", "soft"), F.lit(True))).alias("odd")).first()
    if size["n"] > MAX_TERMS or size["chars"] > MAX_CHARS:
        raise ValueError(f"a vocabulary has at most {MAX_TERMS} terms and {MAX_CHARS} characters")
    if size["odd"]:
        raise ValueError("the kind of a term is strict or soft")
    return tuple(Term(r["term"], r["kind"] == "strict", r["weight"]) for r in rows.toLocalIterator())


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host, its subdomains and the paths under ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules that the contract of the registered query fixes.
CONTRACT_RULES = (Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    if url is None:
        return "", ""
    _, sep, rest = url.partition("://")
    if not sep:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    tail = rest[end:]
    stop = min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))
    return rest[:end].encode().lower().decode(), tail[:stop]


class RuleBook:
    """Rules by host; a url is looked up once per label of its host."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.by_host: dict[str, list[Rule]] = {}
        for r in sorted(rules, key=lambda r: (-len(r.path), r.verdict != "block", r.path)):
            self.by_host.setdefault(r.host, []).append(r)

    def find(self, host: str, path: str) -> Rule | None:
        """The longest rule that fits: the most specific host or path text; block wins a tie."""
        best = None
        while host:
            for r in self.by_host.get(host, ()):
                if path.startswith(r.path) and (best is None or (len(r.text), r.verdict == "block") > (len(best.text), best.verdict == "block")):
                    best = r
            host = host.partition(".")[2]
        return best


class Vocabulary:
    """Aho-Corasick automaton over weighted terms."""

    def __init__(self, terms: Iterable[Term], min_soft: int):
        if min_soft < 1:
            raise ValueError("min_soft must be 1 or more")
        self.min_soft = min_soft
        self.weight: dict[str, float] = {}
        self.hard: set[str] = set()
        for t in terms:
            text = t.text.encode().lower().decode()
            if text:
                self.weight[text] = max(self.weight.get(text, 0.0), float(min_soft) if t.strict else t.weight)
                self.hard.update((text,) if t.strict else ())
        self.automaton = ahocorasick.Automaton()
        for text in self.weight:
            self.automaton.add_word(text, text)
        if self.weight:
            self.automaton.make_automaton()

    @staticmethod
    def _word(c: str) -> bool:
        return c.isascii() and c.isalnum()

    def terms(self, url: str | None) -> list[str]:
        """Distinct terms of the url that stand between boundaries, in order of their text."""
        if not url or not self.weight:
            return []
        low = url.encode().lower().decode()
        found = set()
        for last, term in self.automaton.iter(low):
            first = last - len(term) + 1
            if term not in found and not (first and self._word(low[first - 1])) and not (last + 1 < len(low) and self._word(low[last + 1])):
                found.add(term)
        return sorted(found)

    def rejects(self, terms: list[str]) -> bool:
        """Whether the distinct terms of a url suffice: one strict, or enough soft ones of enough weight."""
        return any(t in self.hard for t in terms) or (len(terms) >= self.min_soft and sum(self.weight[t] for t in terms) >= self.min_soft)


def filter_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: tuple[Rule, ...] = (),
    vocabulary: tuple[Term, ...] = PRODUCTION,
    min_soft: int = 2,
) -> DataFrame:
    """One row per row of ``pages``: its id (as ``page_id``), host, path, rule, verdict, terms, n_strict, n_soft, score (sum of weights)."""
    if len(vocabulary) > MAX_TERMS or sum(len(t.text) for t in vocabulary) > MAX_CHARS:
        raise ValueError(f"a vocabulary has at most {MAX_TERMS} terms and {MAX_CHARS} characters")
    shared = pages.sparkSession.sparkContext.broadcast(vocabulary)
    key = uuid.uuid4().hex

    def judge(rows: Iterator[tuple]) -> Iterator[tuple]:
        book, known = RuleBook(rules), kept_in_worker(key, lambda: Vocabulary(shared.value, min_soft))
        for page, url in rows:
            host, path = host_and_path(url)
            rule, terms = book.find(host, path), known.terms(url)
            n_strict = sum(t in known.hard for t in terms)
            verdict = rule.verdict if rule else "block" if known.rejects(terms) else "allow"
            yield page, host, path, rule and rule.text, verdict, terms, n_strict, len(terms) - n_strict, sum(known.weight[t] for t in terms)

    kind = pages.schema[id_col].dataType.simpleString()
    fields = [
        ("page_id", "string", pa.string()), ("host", "string", pa.string()), ("path", "string", pa.string()), ("rule", "string", pa.string()), ("verdict", "string", pa.string()),
        ("terms", "array<string>", pa.list_(pa.string())), ("n_strict", "int", pa.int32()), ("n_soft", "int", pa.int32()), ("score", "double", pa.float64()),
    ]
    kept = pages.select(F.col(id_col).cast("string").alias("page_id"), F.col(url_col).cast("string").alias("url"))
    return map_texts(kept, judge, fields, "page_id", "url", keeps=True).withColumn("page_id", F.col("page_id").cast(kind))
