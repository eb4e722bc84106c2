"""URL filters: site rules first, else a weighted vocabulary.

The vocabulary is matched by one Aho-Corasick automaton over the url, in which
escapes of ASCII characters (``%20`` to ``%7F``) are decoded once, lower-cased.
An occurrence counts only between boundaries (no ASCII letter or digit
beside it). A strict term weighs as much as the limit, a soft one 1, each
distinct term once: one strict or several distinct soft terms block a url.
Host, path and rules are column expressions on the url as it is; only the url
goes to Python. ``read_terms`` reads a vocabulary of one's own from text files.

Defined results: a null url, or one without ``://``, has empty host and path,
fits no rule, and the vocabulary judges what there is of it (null: allow);
incomplete escapes stay as they are; an empty vocabulary allows every url.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import whole

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: (host and path, verdict). A rule holds for its host and all subdomains where the path begins with the rule's.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
# Terms that block alone, and terms that block together with another one.
STRICT = (
    "porn", "porno", "pornos", "pornstar", "pornstars", "xxx", "hentai", "milf", "milfs", "camgirl", "camgirls", "sexcam", "sexcams", "nsfw",
    "warez", "keygen", "keygens", "serialz", "nulled", "pornofilme", "sexfilme", "sexkontakte", "pornographie", "pornografia", "pornogratis",
)
SOFT = (
    # English
    "adult", "sex", "sexy", "nude", "nudes", "naked", "escort", "escorts", "dating", "casino", "poker", "betting", "slots", "jackpot", "roulette",
    "blackjack", "viagra", "cialis", "pills", "payday", "torrent", "torrents", "crack", "cracked", "gambling", "webcam", "hookup", "hookups", "erotic", "fetish",
    # German
    "erotik", "nackt", "wetten", "sportwetten", "spielautomaten", "gluecksspiel", "seitensprung", "potenzmittel", "sofortkredit",
    # French
    "sexe", "erotique", "nue", "nues", "rencontres", "libertin", "paris-sportifs",
    # Spanish
    "sexo", "erotico", "erotica", "desnuda", "desnudas", "apuestas", "tragaperras", "citas", "ruleta",
    # Italian
    "sesso", "nuda", "scommesse", "incontri",
    # Portuguese
    "apostas", "acompanhantes", "pelada", "peladas", "namoro",
    # Dutch
    "seks", "naakt", "gokken", "gokkasten",
)
#: A url whose distinct terms weigh this much is blocked; strict terms weigh as much.
BLOCK_AT = 2
#: A vocabulary goes to every Python worker: so many terms at most, of so many characters each.
MAX_TERMS, MAX_TERM = 200_000, 100
ESCAPE = re.compile("%([2-7][0-9A-Fa-f])")


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        of, slash, rest = text.partition("/")
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(text)).otherwise(name), F.when(fits, F.lit(says)).otherwise(verdict)
    return name, verdict


def read_terms(spark: SparkSession, path: str) -> tuple[tuple, tuple]:
    """(strict, soft) terms from text files of one term a line; ``!`` before a term makes it strict. Lines
    that are blank or begin with ``#`` are no terms; A-Z are lower-cased; a term that is listed as both is strict."""
    line = F.trim(F.translate("value", UPPER, LOWER))
    terms = spark.read.text(path).select(F.regexp_replace(line, r"^!\s*", "").alias("term"), line.startswith("!").alias("strict"))
    terms = terms.filter("term <> '' and not startswith(term, '#')").groupBy("term").agg(F.max("strict").alias("strict"))
    n, longest = terms.agg(F.count("*"), F.coalesce(F.max(F.length("term")), F.lit(0))).first()
    if n > MAX_TERMS or longest > MAX_TERM:
        raise ValueError(f"{n} terms, the longest of {longest} characters: at most {MAX_TERMS} of {MAX_TERM} are taken")
    rows = terms.orderBy("term").collect()
    return tuple(r.term for r in rows if r.strict), tuple(r.term for r in rows if not r.strict)


def _terms(strict: tuple, soft: tuple):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        words = ahocorasick.Automaton()
        for term in (*soft, *strict):
            words.add_word(term, term)
        words.make_automaton()
        hard, ends = set(strict), set("0123456789" + LOWER)
        lower = str.maketrans(UPPER, LOWER)

        def found(url: str | None) -> tuple[int, int]:
            text = ESCAPE.sub(lambda m: chr(int(m[1], 16)), url or "").translate(lower)
            terms = {t for end, t in words.iter(text) if not ends & set(text[end + 1 : end + 2] + text[max(0, end - len(t)) : end - len(t) + 1])} if text and len(words) else ()
            return sum(t in hard for t in terms), sum(t not in hard for t in terms)

        for urls in batches:
            yield pd.DataFrame([found(u) for u in urls], columns=["n_strict", "n_soft"])

    return F.pandas_udf(run, "n_strict int, n_soft int")


def filter_urls(pages: DataFrame, rules: tuple = RULES, strict: tuple = STRICT, soft: tuple = SOFT, block_at: int = BLOCK_AT) -> DataFrame:
    """``pages`` with url_host, url_path, url_rule, n_strict, n_soft (distinct terms) and url_verdict."""
    url = F.col("url")
    rows = pages.select(whole(pages), host(url).alias("host"), path(url).alias("path"), _terms(strict, soft)(url).alias("terms"))
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    weight = F.col("terms.n_strict") * block_at + F.col("terms.n_soft")
    return rows.select(
        "row", F.col("host").alias("url_host"), F.col("path").alias("url_path"), name.alias("url_rule"), "terms.n_strict", "terms.n_soft",
        F.coalesce(verdict, F.when(weight >= block_at, "block").otherwise("allow")).alias("url_verdict"),
    )


def digest(pages: DataFrame) -> DataFrame:
    return filter_urls(pages.select("page_id", "url")).select(
        "row.page_id", F.col("url_host").alias("host"), F.col("url_path").alias("path"), F.col("url_rule").alias("rule"),
        F.col("url_verdict").alias("verdict"), "n_strict", "n_soft")
