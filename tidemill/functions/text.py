"""Text functions as Columns: all run in the JVM, none needs a Python worker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.strip() knows it; Spark's trim() knows U+0020 alone.
WS = "[\\s\\x1c-\\x1f\\x85\\u00a0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"
WHITE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Role words that carry nothing in a blocking key.
ROLE_WORDS = ["user", "assistant", "system"]
EMPTY_HEAD = "__EMPTY__"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space at either end: one pass from each, however long the runs inside are."""
    return F.btrim(col(c), F.lit(WHITE))


def blank(c: Column | str) -> Column:
    """Null, or nothing but white space: read up to the first other character."""
    return ~F.coalesce(col(c).rlike(f"[^{WS[1:-1]}]"), F.lit(False))


def ws_norm(c: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(col(c), f"{WS}+", " "))


def dedup_norm(c: Column | str) -> Column:
    """Lower case, every character but letters, numbers and underscores as space, runs as one, none at the ends."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^\\p{L}\\p{N}_\\s]", " "), "\\s+", " "))


def text_hash(c: Column | str, algorithm: str = "sha1") -> Column:
    """Hex digest of the UTF-8 text: sha1, md5 or sha256."""
    return {"sha1": lambda x: F.sha1(x), "md5": lambda x: F.md5(x), "sha256": lambda x: F.sha2(x, 256)}[algorithm](col(c))


def truth_hash_or_blank(c: Column | str) -> Column:
    """Fingerprint of a ground truth, '' if it is blank (exact deduplication)."""
    return F.when(blank(c), "").otherwise(F.sha1(strip(c)))


def truth_hash(c: Column | str) -> Column:
    """Fingerprint of a ground truth, blank ones included (fuzzy deduplication)."""
    return F.sha1(F.coalesce(strip(c), F.lit("")))


def cjk_ratio(c: Column | str) -> Column:
    """Part of the characters in U+4E00-9FFF; 0 for empty text."""
    t = F.coalesce(col(c), F.lit(""))
    n = F.length(t)
    return F.when(n == 0, 0.0).otherwise((n - F.length(F.regexp_replace(t, "[\\u4e00-\\u9fff]", ""))) / n)


def head_tokens(norm: Column | str, n: int) -> Column:
    """The first n tokens of normalised text that are no role words, joined by '_'; EMPTY_HEAD if there are none."""
    toks = F.filter(F.split(col(norm), " "), lambda t: (t != "") & ~t.isin(ROLE_WORDS))
    return F.when(F.size(toks) == 0, EMPTY_HEAD).otherwise(F.array_join(F.slice(toks, 1, n), "_"))


def length_bin(norm: Column | str, width: int = 100) -> Column:
    return F.floor(F.length(col(norm)) / width).cast("int")


def bucket_key(norm: Column | str, n: int = 2, width: int = 100) -> Column:
    return F.concat_ws("__", head_tokens(norm, n), length_bin(norm, width).cast("string"))


def source_name(c: Column | str) -> Column:
    """An id up to its last '/'; '__MISSING__' if nothing is left."""
    return F.coalesce(F.nullif(F.regexp_replace(col(c), "/[^/]*$", ""), F.lit("")), F.lit("__MISSING__"))


def missing(c: Column | str) -> Column:
    return F.coalesce(col(c), F.lit("__MISSING__"))


def one_line(c: Column | str, most: int | None = None) -> Column:
    """On one line; cut to `most` characters, if given, for models that read no more."""
    return ws_norm(c) if most is None else F.substring(ws_norm(c), 1, most)


def split_sentences(c: Column | str) -> Column:
    return F.filter(F.transform(F.split(col(c), "[.!?]+"), strip), lambda s: s != "")


THINK = "(?is)<think>(.*?)</think>"
ANSWER = "(?is)<answer>(.*?)</answer>"


def think_text(c: Column | str) -> Column:
    """The first <think> block, null if there is none."""
    return F.when(col(c).rlike(THINK), strip(F.regexp_extract(col(c), THINK, 1)))


def answer_text(c: Column | str) -> Column:
    """The first <answer> block, null if there is none."""
    return F.when(col(c).rlike(ANSWER), strip(F.regexp_extract(col(c), ANSWER, 1)))


def response_text(c: Column | str) -> Column:
    """What is left without any <think> or <answer> block."""
    return strip(F.regexp_replace(F.regexp_replace(col(c), THINK, ""), ANSWER, ""))


def balanced_think(c: Column | str) -> Column:
    """The first opening tag stands before the first closing one."""
    t = F.lower(col(c))
    a, b = F.instr(t, "<think>"), F.instr(t, "</think>")
    return (a > 0) & (b > 0) & (a < b)


def most_common(items: Column) -> Column:
    """struct(item, n) of the most frequent element, the first seen among equals; null for none.

    Elements are sorted with their places, so equal ones form runs: O(n log n), where comparing each with each takes n^2.
    """
    with_place = F.array_sort(F.transform(items, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    start = F.struct(F.lit(None).cast("string").alias("x"), F.lit(0).alias("n"), F.lit(0).alias("at"), F.lit(None).cast("string").alias("bx"), F.lit(0).alias("bn"), F.lit(0).alias("bat"))

    def step(a: Column, e: Column) -> Column:
        same = F.coalesce(a["x"] == e["x"], F.lit(False))
        n, at = F.when(same, a["n"] + 1).otherwise(1), F.when(same, a["at"]).otherwise(e["i"])
        better = (n > a["bn"]) | ((n == a["bn"]) & (at < a["bat"]))
        return F.struct(e["x"].alias("x"), n.alias("n"), at.alias("at"), F.when(better, e["x"]).otherwise(a["bx"]).alias("bx"), F.when(better, n).otherwise(a["bn"]).alias("bn"), F.when(better, at).otherwise(a["bat"]).alias("bat"))

    return F.aggregate(with_place, start, step, lambda a: F.when(a["bn"] > 0, F.struct(a["bx"].alias("item"), a["bn"].alias("n"))))


def ngrams(c: Column | str, n: int) -> Column:
    """Word n-grams of normalised lower-case text."""
    words = F.filter(F.split(F.lower(ws_norm(c)), " "), lambda t: t != "")
    grams = F.transform(F.array(words), lambda w: F.transform(F.slice(w, 1, F.greatest(F.size(w) - n + 1, F.lit(0))), lambda x, i: F.array_join(F.slice(w, i + 1, n), " ")))
    return grams[0]


def repeated_sentence(c: Column | str) -> Column:
    """struct(item, n): the most frequent normalised sentence."""
    return most_common(F.filter(F.transform(split_sentences(c), lambda s: F.lower(ws_norm(s))), lambda s: s != ""))


def repeated_ngram(c: Column | str, n: int) -> Column:
    return most_common(ngrams(c, n))


def is_think_format(c: Column | str) -> Column:
    """One think block, then a response."""
    return F.coalesce(col(c).rlike("(?is)\\A\\s*<think>.*?</think>.+\\z"), F.lit(False))


def is_answer_format(c: Column | str) -> Column:
    """One think block, then one answer block, and nothing else."""
    return F.coalesce(col(c).rlike("(?is)\\A\\s*<think>.*?</think>\\s*<answer>.*?</answer>\\s*\\z"), F.lit(False))


# Labels of languages with their scripts, and their short codes.
LANGUAGE_LABELS = {
    "eng_Latn": "en", "deu_Latn": "de", "fra_Latn": "fr", "spa_Latn": "es", "por_Latn": "pt", "ita_Latn": "it", "nld_Latn": "nl", "pol_Latn": "pl", "rus_Cyrl": "ru", "ukr_Cyrl": "uk",
    "ces_Latn": "cs", "slk_Latn": "sk", "ron_Latn": "ro", "hun_Latn": "hu", "fin_Latn": "fi", "swe_Latn": "sv", "nor_Latn": "no", "dan_Latn": "da", "tur_Latn": "tr", "vie_Latn": "vi",
    "ind_Latn": "id", "msa_Latn": "ms", "tha_Thai": "th", "zho_Hans": "zh", "zho_Hant": "zh", "jpn_Jpan": "ja", "kor_Hang": "ko", "ara_Arab": "ar", "arb_Arab": "ar", "heb_Hebr": "he",
    "hin_Deva": "hi", "ben_Beng": "bn", "tam_Taml": "ta", "tel_Telu": "te", "kan_Knda": "kn", "mar_Deva": "mr", "urd_Arab": "ur", "fas_Arab": "fa", "swh_Latn": "sw", "cat_Latn": "ca",
    "ell_Grek": "el", "bul_Cyrl": "bg", "hrv_Latn": "hr", "srp_Cyrl": "sr", "slv_Latn": "sl", "lit_Latn": "lt", "lav_Latn": "lv", "est_Latn": "et", "yue_Hant": "zh", "wuu_Hans": "zh",
    "wuu_Hant": "zh", "hak_Hant": "zh", "nan_Hant": "zh", "nob_Latn": "no", "nno_Latn": "no", "afr_Latn": "af", "glg_Latn": "gl", "eus_Latn": "eu", "isl_Latn": "is", "mkd_Cyrl": "mk",
    "bel_Cyrl": "be", "kaz_Cyrl": "kk", "uzb_Latn": "uz", "aze_Latn": "az", "tgl_Latn": "tl", "mya_Mymr": "my", "khm_Khmr": "km", "sin_Sinh": "si", "nep_Deva": "ne", "som_Latn": "so",
    "amh_Ethi": "am", "hau_Latn": "ha", "yor_Latn": "yo", "ibo_Latn": "ig", "zul_Latn": "zu",
}


def language_code(label: Column | str, codes: dict[str, str] | None = None) -> Column:
    """A label's short code: by table ('__label__' before it does not count), or its first two letters in lower case."""
    plain = F.regexp_replace(col(label), "^__label__", "")
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in (codes or LANGUAGE_LABELS).items() for x in kv]), plain), F.substring(F.lower(plain), 1, 2))
