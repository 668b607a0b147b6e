"""Text as Column expressions: keys, tokens, sentences, numbers, labels. Everything here stays in the JVM.

Functions take and give Columns. Null in gives null out unless a docstring says otherwise. Patterns that must agree
with Python's Unicode classes carry ``(?U)``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no content in questions and claims.
STOPWORDS = "a an the of in on at for from to and or with by is are was were be been this that these those its their his her".split()
# Strings that mean a missing value.
MISSING = ("none", "nan", "null")
# Letters with marks and their plain forms, for title keys.
ACCENTED, PLAIN = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"
#: Characters that a pattern reads as its own.
_QUOTED = r"([\\.\[\]{}()*+?^$|/-])"


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once; inside a lambda an expression would be computed for every element."""
    return F.element_at(F.transform(F.array(c), use), 1)


def clean(c: Column) -> Column:
    """Trimmed, with the strings that mean missing, and null, as empty."""
    t = F.trim(F.coalesce(c, F.lit("")))
    return F.when(F.lower(t).isin(*MISSING), "").otherwise(t)


def norm_ascii(c: Column) -> Column:
    """F1 for text without characters that NFKC or case folding change beyond lower(): the comparison key."""
    t = F.translate(F.lower(c), "’–—", "'--")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"(?U)[^\w\s\-/%.']", " "), r"(?U)\s+", " "))


def tokens(c: Column, least: int = 1) -> Column:
    """the key's words without stopwords, of at least so many characters."""
    return F.filter(F.split(norm_ascii(c), " "), lambda w: (F.length(w) >= least) & ~w.isin(*STOPWORDS))


def words(c: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), 0)


def inverted_index(w: Column) -> Column:
    """the distinct words of an array, sorted, each with its places from 0. One sort of the row's own words."""
    placed = F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("term"), i.alias("at"))))
    opens = lambda s: F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i)["term"] != F.get(s, i - 1)["term"]))
    run = lambda s, starts, b, j: F.slice(s, b + 1, F.coalesce(F.get(starts, j + 1), F.size(s)) - b)
    entry = lambda s, starts: F.transform(starts, lambda b, j: F.struct(F.get(s, b)["term"].alias("term"), F.transform(run(s, starts, b, j), lambda x: x["at"]).alias("places")))
    some = let(placed, lambda s: let(opens(s), lambda starts: entry(s, starts)))
    return F.when(F.size(w) > 0, some).when(w.isNotNull(), F.array().cast("array<struct<term:string,places:array<int>>>"))


def text_of_index(index: Column) -> Column:
    """the words of an inverted index (term, places) in order of their places, joined by a space."""
    pairs = F.flatten(F.transform(index, lambda e: F.transform(e["places"], lambda p: F.struct(p.alias("at"), e["term"].alias("term")))))
    return F.array_join(F.transform(F.sort_array(pairs), lambda p: p["term"]), " ")


def or_query(c: Column) -> Column:
    """the distinct content tokens quoted and joined by OR; of all tokens if none has three characters."""
    long, every = tokens(c, 3), tokens(c)
    chosen = F.array_distinct(F.when(F.size(long) > 0, long).otherwise(every))
    return F.when(F.size(chosen) == 0, '""').otherwise(F.array_join(F.transform(chosen, lambda w: F.concat(F.lit('"'), w, F.lit('"'))), " OR "))


def ngrams(c: Column, n: int = 3, pad: tuple[str, str] = (" ", " ")) -> Column:
    """the character n-grams of the padded text."""
    t = F.concat(F.lit(pad[0]), c, F.lit(pad[1]))
    return F.when(F.length(t) >= n, F.transform(F.sequence(F.lit(1), F.length(t) - n + 1), lambda i: F.substring(t, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))


def literal_pattern(c: Column) -> Column:
    """A text as a pattern that matches just it."""
    return F.regexp_replace(c, _QUOTED, r"\\$1")


def mentions(text: Column, phrase: Column) -> Column:
    """the phrase stands in the text as whole words."""
    return (F.length(phrase) > 0) & F.rlike(text, F.concat(F.lit(r"(?U)(?<!\w)"), literal_pattern(phrase), F.lit(r"(?!\w)")))


def skeleton(c: Column) -> Column:
    """letters and digits only."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")


def term(word: Column) -> Column:
    """a light stem: plural and participle endings off words that stay long enough."""
    n = F.length(word)
    return (
        F.when((n > 5) & word.endswith("ies"), F.concat(F.substring(word, F.lit(1), n - 3), F.lit("y")))
        .when((n > 5) & word.endswith("ing"), F.substring(word, F.lit(1), n - 3))
        .when((n > 4) & word.endswith("ed"), F.substring(word, F.lit(1), n - 2))
        .when((n > 4) & word.endswith("s") & ~word.endswith("ss"), F.substring(word, F.lit(1), n - 1))
        .otherwise(word)
    )


def content_terms(c: Column, least: int = 3) -> Column:
    """F8: the distinct stems of content words, in order."""
    return F.array_distinct(F.transform(F.filter(words(c), lambda w: (F.length(w) >= least) & ~w.isin(*STOPWORDS)), term))


def numbers(c: Column) -> Column:
    """the distinct runs of digits."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit("[0-9]+"), 0))


def canonical_number(c: Column) -> Column:
    """thousands commas and trailing zeros off."""
    plain = F.regexp_replace(c, ",", "")
    return F.when(plain.contains("."), F.regexp_replace(F.regexp_replace(plain, "0+$", ""), r"\.$", "")).otherwise(plain)


def sentences(c: Column, capital: bool = False) -> Column:
    """cut after . ! ? and white space, or only before a capital or a digit; blanks dropped."""
    cut = r"(?<=[.!?])\s+(?=[A-Z0-9])" if capital else r"(?<=[.!?])\s+|\n+"
    return F.filter(F.transform(F.split(c, cut), lambda s: F.trim(s)), lambda s: F.length(s) > 0)


def title_tokens(c: Column, stop: Iterable[str] = STOPWORDS) -> Column:
    """words of more than two letters, after tags, entities and marks are off, each once and sorted."""
    t = F.regexp_replace(F.regexp_replace(F.lower(c), "<[^>]*>", " "), "&[a-z]+;|&#[0-9]+;", " ")
    t = F.translate(t, ACCENTED, PLAIN)
    return F.array_sort(F.array_distinct(F.filter(F.regexp_extract_all(t, F.lit("[a-z0-9]+"), 0), lambda w: (F.length(w) > 2) & ~w.isin(*stop))))


def rare_key(c: Column, keep: int = 5, least: int = 4) -> Column:
    """F32: the first words, by alphabet, of at least four letters: a fingerprint of a title."""
    found = F.regexp_extract_all(F.lower(c), F.lit("[a-z]{%d,}" % least), 0)
    return F.slice(F.array_sort(F.array_distinct(F.filter(found, lambda w: ~w.isin(*STOPWORDS)))), 1, keep)


def family_key(discipline: Column, title: Column, keep: int = 4) -> Column:
    """the discipline and the first words, by alphabet and with repeats, of a title."""
    found = F.filter(F.regexp_extract_all(F.lower(title), F.lit("[a-z]{4,}"), 0), lambda w: ~w.isin(*STOPWORDS))
    return F.concat_ws("|", discipline, F.array_join(F.slice(F.array_sort(found), 1, keep), " "))


def surnames(authors_json: Column) -> Column:
    """the last words of the names in a JSON list, lower case, each once and sorted; bad JSON gives none."""
    names = F.coalesce(F.from_json(authors_json, "array<string>"), F.array().cast("array<string>"))
    return F.array_sort(F.array_distinct(F.filter(F.transform(names, lambda n: F.lower(F.element_at(F.split(F.trim(n), r"\s+"), -1))), lambda n: F.length(n) > 0)))


def licence_tier(c: Column) -> Column:
    """1 quotable, 2 usable for training only, 3 neither or unknown."""
    t = norm_ascii(F.coalesce(c, F.lit("")))
    open_ = F.rlike(t, F.lit("cc0|public domain|cc[ -]by|creative commons attribution"))
    closed = F.array_contains(F.split(t, " "), "nd") | t.contains("no deriv")
    return F.when(open_ & closed, 3).when(open_ | t.contains("open access"), 1).when(F.rlike(t, F.lit("tdm|text and data mining|training permitted")), 2).otherwise(3)


def licence_name(c: Column) -> Column:
    """a Creative Commons address as its short name, without the version."""
    t = F.replace(F.lower(F.trim(c)), F.lit("_"), F.lit("-"))
    of_url = F.regexp_replace(F.trim(F.regexp_replace(t, "^https?://creativecommons[.]org/licenses/", ""), F.lit("/")), "/[0-9]+([.][0-9]+)?$", "")
    named = F.when(of_url.startswith("cc-"), of_url).otherwise(F.concat(F.lit("cc-"), F.replace(of_url, F.lit("/"), F.lit("-"))))
    return F.when(F.rlike(t, F.lit("^https?://creativecommons[.]org/licenses/")), named).otherwise(of_url)


def licence_rank(c: Column, tiers: dict[int, list[str]]) -> Column:
    """the tier that names the licence; 4 if there is none, 5 if no tier names it."""
    t = F.coalesce(c, F.lit(""))
    named = reduce(lambda w, kv: w.when(t.isin(*kv[1]), kv[0]), list(tiers.items())[1:], F.when(t.isin(*tiers[min(tiers)]), min(tiers)))
    return named.when(t == "", 4).otherwise(5)


def doi_key(c: Column) -> Column:
    """a DOI without its address."""
    return F.regexp_replace(F.lower(F.trim(c)), r"^(https?://(dx\.)?doi\.org/|doi:\s*)", "")


def work_id(c: Column) -> Column:
    """the W number of an address."""
    return F.upper(F.regexp_extract(c, "([Ww][0-9]+)", 1))


def plausible_year(c: Column, now: int) -> Column:
    """the first four digits as a year between 1800 and next year, else null."""
    y = F.regexp_extract(c, "([0-9]{4})", 1).try_cast("int")
    return F.when(y.between(1800, now + 1), y)


def citation_label(families: Column, year: Column) -> Column:
    """one author, two, or the first and others, with the year."""
    n, at = F.size(families), lambda k: F.try_element_at(families, F.lit(k))
    who = F.when(n == 0, "Unknown").when(n == 1, at(1)).when(n == 2, F.concat(at(1), F.lit(" & "), at(2))).otherwise(F.concat(at(1), F.lit(" et al.")))
    return F.concat(who, F.lit(", "), F.coalesce(year.cast("string"), F.lit("n.d.")))


def citation_parts(label: Column) -> Column:
    """struct of the first family name and the year in an author-year label; null if it is none."""
    who, year = F.regexp_extract(label, r"^\(?([A-Z][A-Za-z'-]+)", 1), F.regexp_extract(label, "((18|19|20)[0-9]{2})[a-z]?", 1)
    return F.when((F.length(who) > 0) & (F.length(year) > 0), F.struct(F.lower(who).alias("family"), year.cast("int").alias("year")))


def slug(c: Column, most: int = 70) -> Column:
    """F49"""
    return F.left(F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "_"), F.lit("_")), F.lit(most))


def excerpt(text: Column, needle: Column, around: int = 60, most: int = 25) -> Column:
    """so many characters at either side of the first place of the needle, as at most so many words."""
    at = F.instr(F.lower(text), F.lower(needle))
    piece = F.substring(text, F.greatest(F.lit(1), at - around), F.least(at - 1, F.lit(around)) + F.length(needle) + around)
    return F.when(at > 0, F.array_join(F.slice(F.filter(F.split(piece, r"\s+"), lambda w: F.length(w) > 0), 1, most), " "))


def words_first(c: Column, n: int) -> Column:
    """the first words of a text."""
    return F.array_join(F.slice(F.split(F.trim(c), r"\s+"), 1, n), " ")


def token_estimate(c: Column) -> Column:
    """words and punctuation, and eight more, at least one."""
    return F.greatest(F.lit(1), F.size(F.regexp_extract_all(c, F.lit(r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s]"), 0)) + 8)


def mask_citations(c: Column) -> Column:
    """bracketed numbers, author-year brackets and et al. pairs masked out."""
    rules = [r"\[[0-9][0-9,; -]*\]", r"\([A-Z][A-Za-z' -]+(et al\.)?,? (19|20)[0-9]{2}[a-z]?\)", r"[A-Z][A-Za-z'-]+ et al\. \((19|20)[0-9]{2}\)", r"(Fig|Figure|Table|Eq)\.? [0-9]+"]
    return F.trim(F.regexp_replace(reduce(lambda t, r: F.regexp_replace(t, r, " "), rules, c), " +", " "))


def enum_spelling(c: Column) -> Column:
    """F54"""
    return F.regexp_replace(F.upper(F.trim(c)), r"[\s-]+", "_")


def primary_key(c: Column) -> Column:
    """F55 for text in composed form: dashes and apostrophes folded, spaces collapsed, lower case but for formulas."""
    t = F.trim(F.regexp_replace(F.translate(c, "‐‑‒–—’‘", "-----''"), r"\s+", " "))
    return F.when(F.rlike(t, F.lit("^([A-Z][a-z]?[0-9]*){2,}$")), t).otherwise(F.lower(t))


def loose_key(c: Column) -> Column:
    """letters and digits only, lower case."""
    return F.regexp_replace(F.lower(c), r"(?U)[^\p{L}\p{N}]+", "")


def token_key(c: Column) -> Column:
    """the distinct words, sorted."""
    return F.array_join(F.array_sort(F.array_distinct(words(c))), " ")


def acronym(c: Column) -> Column:
    """the first letters of the words."""
    return F.upper(F.array_join(F.transform(words(c), lambda w: F.left(w, F.lit(1))), ""))


def organism_key(c: Column) -> Column:
    """the first two words of an organism's name, without author and year."""
    return F.array_join(F.slice(F.split(F.lower(F.trim(F.regexp_replace(c, r"\([^)]*\)", " "))), r"\s+"), 1, 2), " ")


def normalise_answer(c: Column) -> Column:
    """lower case, no punctuation, no articles, single spaces."""
    t = F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9 ]+", " "), r"\b(a|an|the)\b", " ")
    return F.trim(F.regexp_replace(t, " +", " "))


def exact_match(a: Column, b: Column) -> Column:
    """F70"""
    return (normalise_answer(a) == normalise_answer(b)).cast("int")


def token_f1(a: Column, b: Column) -> Column:
    """F1 of the two multisets of words; 0 if either is empty."""
    x, y = (F.filter(F.split(normalise_answer(c), " "), lambda w: F.length(w) > 0) for c in (a, b))
    count = lambda arr, w: F.size(F.filter(arr, lambda v: v == w))
    same = lambda x, y: F.aggregate(F.array_distinct(x), F.lit(0), lambda s, w: s + F.least(count(x, w), count(y, w)))
    return let(F.struct(x.alias("x"), y.alias("y")), lambda p: F.coalesce(F.try_divide(2.0 * same(p["x"], p["y"]), F.size(p["x"]) + F.size(p["y"])), F.lit(0.0)))


def has_format(c: Column) -> Column:
    """an answer with a statement, a quote and a citation tag."""
    return F.rlike(c, F.lit("[A-Za-z]")) & F.rlike(c, F.lit('"[^"]+"')) & F.rlike(c, F.lit(r"\[E[0-9]+\]"))


def strip_tags(html: Column) -> Column:
    """F46 without entities: scripts, styles, comments and tags off, spaces collapsed."""
    t = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, "<[^>]*>", " "), r"\s+", " "))


def paper_body(c: Column) -> Column:
    """front matter and page markers off, and everything from the last references heading."""
    t = F.regexp_replace(c, r"(?s)\A---\n.*?\n---\n", "")
    t = F.regexp_replace(t, "<!--[^>]*-->", "")
    return F.trim(F.regexp_replace(t, r"(?is)\n#+ *references\b(?!.*\n#+ *references\b).*\z", ""))


def first_page(c: Column, marker: str = "PDF_PAGE: 2", most: int = 16_000) -> Column:
    """what stands before the second page's marker."""
    return F.left(F.split_part(c, F.lit(marker), F.lit(1)), F.lit(most))


def byline_region(page: Column) -> Column:
    """a first page without its abstract."""
    return F.regexp_replace(page, r"(?is)\n\W*abstract\b.*\z", "")


def line_with(text: Column, needle: Column) -> Column:
    """the first line that holds the needle."""
    return F.try_element_at(F.filter(F.split(text, "\n"), lambda s: F.contains(F.lower(s), F.lower(needle))), F.lit(1))


def wrong_script(c: Column, share: float = 0.1) -> Column:
    """Chinese, Japanese, Korean or Cyrillic characters make up so much of the text."""
    hits = F.length(F.regexp_replace(c, "[^\\u0400-\\u04FF\\u3040-\\u30FF\\u4E00-\\u9FFF\\uAC00-\\uD7A3]", ""))
    return (hits > 0) & (hits / F.greatest(F.length(c), F.lit(1)) >= share)


def mojibake(c: Column) -> Column:
    """Characters of wrongly decoded text."""
    return F.rlike(c, F.lit("\\uFFFD|\\u00E2\\u20AC|\\u00C3[\\u0080-\\u00FF]|\\u00C2[\\u00B0\\u00B5]"))


def repeated_ellipsis(c: Column) -> Column:
    """P5: two ellipses, as of a placeholder."""
    return F.rlike(c, F.lit("(?s)(\\.{3}|\\u2026).*(\\.{3}|\\u2026)"))


def valid_url(c: Column) -> Column:
    """an http or https address with a host."""
    return F.coalesce(F.rlike(c, F.lit(r"^https?://[A-Za-z0-9.-]+\.[A-Za-z]{2,}(:[0-9]+)?(/\S*)?$")), F.lit(False))
