"""Streets that texts name, as columns: no step looks at a text more than once.

A name is a run of capitalised words. Where it begins or ends is found by cutting
the text at words like 'ul.' and at what can't belong to a run, not by one pattern
with nested repeats, which would try each beginning again on texts of capitals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What names and numbers are made of, the words beside them, words that stand before 'ulici' without
# being part of the name, and endings of street names in the locative: what is taken off, and the nominative's endings.
CAPITAL, INSIDE = r"[A-ZÀ-Ž]", r"\w.\-À-ž"
NUMBER = r"\d{1,4}(?:/\d{1,4})?[a-zA-Z]?"
BEFORE = r"\b[Uu]l\.|\b[Uu]lic[aiou]"
AFTER = r"ul\.|ulic[aiue]\b"
SQUARE = r"\b[Nn]ám\.|\b[Nn]ámestie|\b[Nn]ámestí"
INITIALS = rf"^(?:{CAPITAL}\.)+$"
STOPWORDS = ["na", "pri", "v", "vo", "byt", "izbový", "izb", "novej", "tejto"]
TAIL_MARKS = " \t\n\x0b\f\r,.:;–-"
ENDINGS = [("skej", 2, ("á", "a")), ("ckej", 2, ("á", "a")), ("ovej", 2, ("a",)), ("nej", 2, ("á", "a"))]
LEAST_LETTERS = 3

#: Where a run ends: at a character of no name, or at white space without a capital behind it.
_BREAK = rf"(?U)[^{INSIDE}\s]|(?<!\s)\s++(?!{CAPITAL})"
#: Stands for the white space before a word that follows names; a text's own are taken out first.
_MARK = "\x01"


def _let(value: Column, use) -> Column:
    """``use(value)``, with the value made once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _first(array: Column, holds) -> Column:
    """Place, from 1, of the first element for which ``holds(element, place)``; null if there is none."""
    return F.get(F.filter(F.transform(array, lambda x, i: F.when(holds(x, i + 1), i + 1)), lambda i: i.isNotNull()), F.lit(0))


def cleaned(run: Column) -> Column:
    """The words of a run up to its first sentence's end (initials don't end one), and before a shouted word that isn't the first."""
    ended = lambda w, i: w.endswith(".") & ~w.rlike(INITIALS)
    shouted = lambda w, i: (i > 1) & (F.length(w) >= 3) & (F.upper(w) == w)
    return _let(F.split(run, r"(?U)\s+"), lambda words: F.slice(words, 1, F.least(F.coalesce(_first(words, ended), F.size(words)), F.coalesce(_first(words, shouted) - 1, F.size(words)))))


def _name(words: Column) -> Column:
    """The words as a name, or null if it is too short."""
    return _let(F.rtrim(F.array_join(words, " "), F.lit(TAIL_MARKS)), lambda name: F.when(F.length(name) >= LEAST_LETTERS, name))


def _behind(text: Column, words: str, named) -> Column:
    """``named(name, house number)`` of what stands behind the first of ``words`` that a capital follows."""

    def cut(tail: Column) -> Column:
        number = lambda run: F.nullif(F.regexp_extract(F.substring(tail, F.length(run) + 1, F.lit(64)), rf"(?U)^\s+({NUMBER})", 1), F.lit(""))
        return _let(F.get(F.split(tail, _BREAK, 2), F.lit(0)), lambda run: _let(_name(cleaned(run)), lambda name: F.when(name.isNotNull(), named(name, number(run)))))

    return _let(F.get(F.split(text, rf"(?U)(?:{words})\s+(?={CAPITAL})", 2), F.lit(1)), lambda tail: F.when(tail.isNotNull(), cut(tail)))


def _ahead(text: Column, named) -> Column:
    """``named(name, null)`` of the name ahead of the first 'ulica' that follows one, without stop words."""
    run = lambda head: F.regexp_extract(F.element_at(F.split(head, _BREAK), -1), rf"(?sU)\b({CAPITAL}.*)$", 1)

    def of(words: Column) -> Column:
        begin = _first(words, lambda w, i: ~F.lower(w).isin(*STOPWORDS))
        return _let(_name(F.slice(words, F.coalesce(begin, F.size(words) + 1), F.size(words))), lambda name: F.when(name.isNotNull(), named(name, F.lit(None).cast("string"))))

    marked = F.regexp_replace(F.translate(text, _MARK, ","), rf"(?U)(?<!\s)\s++(?={AFTER})", _MARK)
    runs = _let(F.split(marked, _MARK), lambda heads: F.filter(F.transform(F.slice(heads, 1, F.size(heads) - 1), run), lambda r: r != ""))
    found = _let(F.get(runs, F.lit(0)), lambda r: F.when(r.isNotNull(), _let(cleaned(r), of)))
    return F.when(text.rlike(rf"(?U)\s(?:{AFTER})"), found)


def _told(street: Column, candidates: Column, number: Column) -> Column:
    return F.struct(street.alias("street"), candidates.alias("candidates"), number.alias("house_number"))


def street_of(*texts: Column) -> Column:
    """(street, candidates, house_number) of the first text that names a street, in the order given (title first); null if none does.

    In a text: 'ul. X 46' or 'ulica X', then 'X ulica', then 'námestie X'. Names of fewer than 3 letters don't count.
    """
    found = []
    for text in texts:
        found += [
            _behind(text, BEFORE, lambda name, number: _told(name, F.array(name), number)),
            _ahead(text, lambda name, number: _told(name, street_candidates(name), number)),
            _behind(text, SQUARE, lambda name, number: _told(F.concat(F.lit("námestie "), name), F.array(F.concat(F.lit("námestie "), name), name), number)),
        ]
    return F.coalesce(*found)


def street_mention(*texts: Column) -> Column:
    """The street that the first of the texts to name one names, or null."""
    return street_of(*texts)["street"]


def street_candidates(name: Column) -> Column:
    """At most four spellings, each word in the nominative, then the name as found if it isn't among them; null for null.

    Words with two nominatives vary, the last the fastest; so of more than two
    such words all but the last two keep their first one.
    """

    def spelt(word: Column, nth: int) -> Column:
        """The word's first or second nominative; the second is null if there is one alone."""
        out = word if nth == 0 else F.lit(None).cast("string")
        for end, cut, tos in reversed(ENDINGS):
            to = F.concat(F.substring(word, F.lit(1), F.length(word) - cut), F.lit(tos[nth])) if nth < len(tos) else F.lit(None).cast("string")
            out = F.when(F.lower(word).endswith(end), to).otherwise(out)
        return out

    def every(pair: Column) -> Column:
        """pair: of each word its place, nominatives, and of the name the places of its last two words with two of them."""
        told, last, before = pair["told"], pair["last"], pair["before"]
        written = lambda *places: F.array_join(F.transform(told, lambda w: F.when(F.coalesce(w["n"].isin(*places), F.lit(False)), w["b"]).otherwise(w["a"])) if places else told["a"], " ")
        return F.array_compact(F.array(written(), F.when(last.isNotNull(), written(last)), F.when(before.isNotNull(), written(before)), F.when(before.isNotNull(), written(before, last))))

    def placed(told: Column) -> Column:
        double = F.transform(F.filter(told, lambda w: w["b"].isNotNull()), lambda w: w["n"])
        return _let(double, lambda d: F.struct(told.alias("told"), F.get(d, F.size(d) - 1).alias("last"), F.get(d, F.size(d) - 2).alias("before")))

    words = F.transform(F.split(F.trim(name), r"\s+"), lambda w, i: F.struct(i.alias("n"), spelt(w, 0).alias("a"), spelt(w, 1).alias("b")))
    made = lambda made: F.when(F.array_contains(made, name), made).otherwise(F.concat(made, F.array(name)))
    return F.when(name.isNotNull(), _let(_let(_let(words, placed), every), made))
