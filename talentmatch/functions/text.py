"""Text column expressions.

Every rule is a native Spark expression so that it stays inside whole-stage
codegen (regexp_replace, split, filter, ...). Regex classes are spelt out so
that Java (Spark) and RE2 (the DuckDB oracle) agree: their bare ``\\s``,
``\\w`` and ``\\d`` differ from Python's Unicode ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the behaviour being reproduced)
# ---------------------------------------------------------------------------

# Tokens that a pandas text reload turns into nulls (F16), in pandas' order.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Control characters removed by the sanitiser (F5): keeps tab, LF and CR.
CONTROL_CLASS = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F]"

# Unicode white space (Python's str.split / str.strip set minus U+001C-U+001F,
# which the sanitiser removes first).
WS_CLASS_BODY = (r"\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                 r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS_CLASS = f"[{WS_CLASS_BODY}]"

# Python ``\d`` (Unicode decimal digits) and ``[^\w\s]`` (punctuation).
DIGITS = r"\p{Nd}+"
PUNCT = rf"[^\p{{L}}\p{{N}}_{WS_CLASS_BODY}]"

# Bag-of-words token: runs of two or more word characters.
BOW_TOKEN = r"[\p{L}\p{N}_]{2,}"

# The hire status that makes the label 1.
HIRED_STATUS = "contratado pela decision"


# The published Portuguese stop-word list (F7), the one StopWordsRemover ships.
STOP_WORDS_PT = """
de a o que e do da em um para com não uma os no se na por mais as dos como mas ao ele das à seu sua
ou quando muito nos já eu também só pelo pela até isso ela entre depois sem mesmo aos seus quem nas
me esse eles você essa num nem suas meu às minha numa pelos elas qual nós lhe deles essas esses
pelas este dele tu te vocês vos lhes meus minhas teu tua teus tuas nosso nossa nossos nossas dela
delas esta estes estas aquele aquela aqueles aquelas isto aquilo estou está estamos estão estive
esteve estivemos estiveram estava estávamos estavam estivera estivéramos esteja estejamos estejam
estivesse estivéssemos estivessem estiver estivermos estiverem hei há havemos hão houve houvemos
houveram houvera houvéramos haja hajamos hajam houvesse houvéssemos houvessem houver houvermos
houverem houverei houverá houveremos houverão houveria houveríamos houveriam sou somos são era
éramos eram fui foi fomos foram fora fôramos seja sejamos sejam fosse fôssemos fossem for formos
forem serei será seremos serão seria seríamos seriam tenho tem temos tém tinha tínhamos tinham tive
teve tivemos tiveram tivera tivéramos tenha tenhamos tenham tivesse tivéssemos tivessem tiver
tivermos tiverem terei terá teremos terão teria teríamos teriam
""".split()


def stop_words() -> tuple[str, ...]:
    """The Portuguese stop words; a constant, so that importing needs no file and no JVM."""
    return tuple(STOP_WORDS_PT)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Scalar rules
# ---------------------------------------------------------------------------

def strip_ws(c) -> Column:
    """str.strip() over Unicode white space (plain ``trim`` only strips spaces)."""
    return F.regexp_replace(_c(c), f"^{WS_CLASS}+|{WS_CLASS}+$", "")


def remove_control(c) -> Column:
    """drop control characters except tab, LF and CR."""
    return F.regexp_replace(_c(c), CONTROL_CLASS, "")


def na_to_null(c) -> Column:
    """F16: NA tokens of a text reload become SQL NULL."""
    col = _c(c)
    return F.when(col.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(col)


def clean_text(c) -> Column:
    """F2 -> F3 -> F4: lower case, drop digits, drop punctuation."""
    t = F.lower(_c(c).cast("string"))
    t = F.regexp_replace(t, DIGITS, "")
    return F.regexp_replace(t, PUNCT, "")


def split_ws(c) -> Column:
    """split on runs of white space, no empty tokens."""
    return F.filter(F.split(_c(c), f"{WS_CLASS}+"), lambda x: x != F.lit(""))


def drop_stop_words(tokens, words=None) -> Column:
    """remove stop words, keeping order and repeats (array_except would dedupe)."""
    stop = F.array(*[F.lit(w) for w in (words if words is not None else stop_words())])
    return F.filter(_c(tokens), lambda x: ~F.array_contains(stop, x))


def join_tokens(tokens) -> Column:
    """re-join tokens with single spaces."""
    return F.array_join(_c(tokens), " ")


def bow_tokens(c) -> Column:
    """Lower-case runs of >= 2 word characters (TF-IDF tokenizer)."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(BOW_TOKEN), F.lit(0))


def ngrams_1_2(tokens) -> Column:
    """T4: unigrams followed by adjacent bigrams. ``tokens`` is bound to a lambda's variable: an
    expression that the bigrams name several times would be evaluated as often."""
    return F.get(F.transform(F.array(_c(tokens)), _with_bigrams), F.lit(0))


def _with_bigrams(t: Column) -> Column:
    n = F.size(t)
    bigrams = F.when(n > 1, F.zip_with(F.slice(t, 1, F.greatest(n - 1, F.lit(1))),
                                        F.slice(t, 2, F.greatest(n - 1, F.lit(1))),
                                        lambda a, b: F.concat_ws(" ", a, b))
                     ).otherwise(F.array().cast("array<string>"))
    return F.concat(t, bigrams)


def preview(c, n: int = 150) -> Column:
    """first ``n`` characters."""
    return F.substring(_c(c), 1, n)
