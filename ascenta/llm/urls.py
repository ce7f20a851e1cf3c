"""URL filters: rules first, then naive Bayes over segmented host and path words."""

from __future__ import annotations

import math
import re
import string
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_arrow

#: Words that speak for a block by themselves, by what they are about. Only unambiguous ones: what
#: ordinary names hold as well, such as free, win or track, is no evidence.
BLOCK_SEEDS = {
    "gambling": "betting bets bingo casino casinos gambling jackpot lottery poker roulette slots",
    "adult": "adult escort escorts nude porn sex xxx",
    "pharmacy": "cialis pills steroids viagra",
    "malware": "cracks keygen malware phish phishing spyware torrent torrents warez",
    "advertising": "ads adserver advert adverts clickbait doorway popunder popup",
    "fraud": "payday replica scam scams spam spammer",
}
BLOCK_WORDS = " ".join(BLOCK_SEEDS.values()).split()
#: Words that speak for an ordinary url.
ALLOW_WORDS = (
    "about academy archive art article articles blogs book books business city college community culture data "
    "developer docs education edu gov event events faq food forum garden guide health help history home journal lab "
    "learn learning library local magazine maps media museum music nature news online paper people photo post posts "
    "press product project radio recipe research review school science search shop society software sport sports "
    "store stories story support team tech time topic travel university weather wiki work world"
).split()
#: Words of any url; they tell the classes apart by nothing.
NEUTRAL_WORDS = (
    "best big blog cheap click club co com de en es example farm for free fr get go good http https index info io link links m my net "
    "new now of one org page pages php ref site street the top track track web win www you"
).split()
#: What each word costs beside its share.
BOUNDARY = 2.0
#: The least share of all tokens that a word has which is collected: at most one over it are.
LEAST_SHARE = 1e-5


@dataclass(frozen=True)
class UrlModel:
    """Unigram costs for the segmentation and log odds (block minus allow) for the words."""

    cost: dict[str, float]
    odds: dict[str, float]
    prior: float
    longest: int = field(default=24)
    #: What an unknown stretch costs at once, and for each letter.
    gap: float = 6.0
    per_char: float = 2.7


def unigram_shares(pages: DataFrame, url_col: str = "url", html_col: str | None = "html", least: float = LEAST_SHARE) -> dict[str, float]:
    """The share of each word (letters a to z, at least two) in all tokens of the urls and texts of *pages*.

    Counted over every row, map side first. Words of a share below *least* are
    not collected, so at most 1 / *least* words come to the driver however large the table is.
    """
    text = F.coalesce(F.col(url_col), F.lit(""))
    if html_col:
        text = F.concat_ws(" ", text, F.regexp_replace(F.coalesce(F.col(html_col), F.lit("")), "<[^>]*>", " "))
    counts = pages.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z]{2,}"), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    frequent = counts.join(F.broadcast(total)).where(F.col("n") >= F.col("total") * F.lit(least))  # one row
    return {r.word: r.n / r.total for r in frequent.collect()}


def train_url_model(
    shares: dict[str, float] | None = None,
    block: list[str] = BLOCK_WORDS,
    allow: list[str] = ALLOW_WORDS,
    neutral: list[str] = NEUTRAL_WORDS,
    smoothing: float = 0.04,
    block_share: float = 0.05,
) -> UrlModel:
    """A unigram model from *shares* of words, and multinomial naive Bayes from the seed words.

    A word's cost is the logarithm of its share and a part for its being a word of
    its own, which keeps names from falling into short frequent words. Ordinary seed words have a share
    of one in 10,000 at least, block words of one in five million, so that they
    are not cut out of names. Each seed word is one training token of its class;
    all other words, however frequent, tell the classes apart by nothing, so a
    url of such words gets the prior, *block_share*.
    """
    shares = dict(shares or {})
    for words, floor in ((allow, 1e-4), (neutral, 1e-4), (block, 2e-7)):
        for w in words:
            shares[w] = max(shares.get(w, 0.0), floor)
    counts = {"block": Counter(block), "allow": Counter(allow)}
    words = set(block) | set(allow)
    size = max(len(block), len(allow))
    rate = {k: {w: (c[w] * size / sum(c.values()) + smoothing) / (size + smoothing * len(words)) for w in words} for k, c in counts.items()}
    odds = {w: math.log(rate["block"][w]) - math.log(rate["allow"][w]) for w in words}
    return UrlModel({w: BOUNDARY - math.log(s) for w, s in shares.items()}, odds, math.log(block_share) - math.log(1 - block_share), max(map(len, shares)))


def segment(name: str, model: UrlModel) -> list[str]:
    """The cheapest split of *name* into words (Viterbi over unigram costs).

    A stretch that is no known word costs a fixed part and more for each
    character, so unknown names stay whole rather than fall into letters, and a
    rare word is not cut out of one. Ties go to the longer last word.
    """
    n = len(name)
    back, gap, per_char = [0] * (n + 1), model.gap, model.per_char
    # Two states: the cost of a split that ends with a known word, and of one inside an unknown stretch.
    known, open_ = [0.0] + [math.inf] * n, [math.inf] * (n + 1)
    from_known, from_open = [0] * (n + 1), [0] * (n + 1)
    for j in range(1, n + 1):
        for i in range(max(0, j - model.longest), j):
            if (c := model.cost.get(name[i:j])) is not None and (t := min(known[i], open_[i]) + c) < known[j]:
                known[j], from_known[j] = t, i
        start, stay = known[j - 1] + gap + per_char, open_[j - 1] + per_char
        open_[j], from_open[j] = (stay, from_open[j - 1]) if stay <= start else (start, j - 1)
        back[j] = from_known[j] if known[j] <= open_[j] else from_open[j]
    out, j = [], n
    while j:
        out.append(name[back[j] : j])
        j = back[j]
    return out[::-1]


_LETTERS = re.compile("[a-z]+")


def url_words(host: str, path: str, model: UrlModel) -> list[str]:
    """Segmented words of the host's labels and the path's parts; digits and marks only separate."""
    return [w for run in _LETTERS.findall(f"{host} {path.lower()}") for w in segment(run, model)]


def block_score(host: str, path: str, model: UrlModel) -> float:
    """Log odds that the url is to be blocked; over 0 means block."""
    return model.prior + sum(model.odds.get(w, 0.0) for w in url_words(host, path, model))


def _rule(host: Column, path: Column, rules: dict[str, list[str]]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; of equally long ones the first by name."""
    verdicts = {r: v for v, names in rules.items() for r in names}
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(verdicts, key=lambda r: (len(r), [-ord(c) for c in r])):
        at, slash, under = r.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + under)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(verdicts[r])).otherwise(verdict)
    return rule, verdict


def filter_urls(df: DataFrame, rules: dict[str, list[str]], id_col: str = "page_id", url_col: str = "url", model: UrlModel | None = None) -> DataFrame:
    """One row per input row: *id_col*, host, path, rule, verdict and score.

    *rules* maps "allow" and "block" to names such as ``example.net/en/``. A rule
    fits its host and all subdomains where the path starts with the rule's; the
    longest one decides. Else naive Bayes over the segmented words decides:
    block where the log odds in *score* are over 0.

    Null urls and urls without ``://`` have an empty host and path, fit no rule
    and are judged by the prior, so they're allowed. Other columns are not read;
    each row is judged alone.
    """
    model = model or train_url_model()
    kind = df.schema[id_col].dataType.simpleString()
    url = F.coalesce(F.col(url_col), F.lit(""))
    pattern = "://([^/?#]*)([^?#]*)"
    split = df.select(
        F.col(id_col).alias("id"),
        F.translate(F.regexp_extract(url, pattern, 1), string.ascii_uppercase, string.ascii_lowercase).alias("host"),
        F.regexp_extract(url, pattern, 2).alias("path"),
    )

    def kernel(batches):
        import pyarrow as pa

        for batch in batches:
            scores = [block_score(h, p, model) for h, p in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], [*batch.schema.names, "score"])

    scored = map_arrow(split, kernel, f"id {kind}, host string, path string, score double", rows=1000)
    rule, verdict = _rule(F.col("host"), F.col("path"), rules)
    ruled = scored.select("*", rule.alias("rule"), verdict.alias("__v"))
    return ruled.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("__v", F.when(F.col("score") > 0, "block").otherwise("allow")).alias("verdict"), "score")
