"""Column functions on text: predicates, cleaning, normalising, splitting."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as Unicode defines it, spelled out for Java's regular expressions.
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
NO_SPACE = r"[^\s\x0b\x1c-\x1f\x85\p{Z}]"
WORD_CHAR = r"[\p{L}\p{N}_]"

# Phrases that mark pages which are no articles, the reasons of HTTP status codes, and word lists.
BOILERPLATE = [
    "Internal Server Error", "__NOEDITSECTION__", "enter your username and password", "forgotten your password", "cookies enabled", "enable JavaScript in your browser.",
    "The page cannot be displayed", "site or edit the error_page",
]
FAILED_REQUEST = ["Request unsuccessful"]
SNAPSHOT_EXTRA = ["404", "Login", "sign in", "tentang kami", "skip to content", "hubungi kami", "laman utama", "Hakcipta terpelihara", "Copyright ©"]
EXAM_PHRASES = ["markah untuk setiap satu", "soalan mesti dijawab dalam", "25 markah", "50 markah"]
META_PHRASES = ["return JSON", "AI language model", "model bahasa AI"]
CHAT_PHRASES = ["dalam konteks di", "terjemah", "artikel itu"]
CLOSING_PHRASES = ["terima kasih kerana menonton", "terima kasih"]
LEXICON = [
    "kebutuhan", "berbeda", "bahwa", "nomor", "RMXX,XXX", "kompleksitas", "listrik", "jawaban", "teknis", "berkualitas", "mencoba", "kampanye", "komunitas", "stabilitas", "Stabilitas", "metode",
    "pria", "butuh", "jadwal", "kasus", "otomatis", "populer", "bisnis", "probabilitas", "rusak", "kapasitas", "rutinitas", "pertama-tama", "bagian", "fungsionalitas", "komoditas", "diekspor",
    " akkan", " bisa", "keren", "konfigurkan", "communique", "berbeda", "bagian-bagian", "butuh", "bahwa", " membaut",
]
CODE_SPELLINGS = [
    (" Kode ", " Kod "), (" kode ", " kod "), ("Kode ", "Kod "), ("kodenya", "kodnya"), ("Kodenya", "Kodnya"), ("opkode", "opkod"), (" kode", " kod"), ("dikodekan", "dikodkan"),
    ("kodks", "kodeks"), ("kode ", "kod "), (" Kode", " Kod"),
]
TEXT_KEYS = ["p", "text", "article_text", "article_body", "content", "contents", "body", "articleBody", "data", "title"]
STATUS_REASONS = {
    400: "Bad Request", 401: "Unauthorized", 402: "Payment Required", 403: "Forbidden", 404: "Not Found", 405: "Method Not Allowed", 406: "Not Acceptable", 407: "Proxy Authentication Required",
    408: "Request Timeout", 409: "Conflict", 410: "Gone", 411: "Length Required", 412: "Precondition Failed", 413: "Payload Too Large", 414: "URI Too Long", 415: "Unsupported Media Type",
    416: "Range Not Satisfiable", 417: "Expectation Failed", 418: "I'm a teapot", 421: "Misdirected Request", 422: "Unprocessable Entity", 423: "Locked", 424: "Failed Dependency", 425: "Too Early",
    426: "Upgrade Required", 428: "Precondition Required", 429: "Too Many Requests", 431: "Request Header Fields Too Large", 451: "Unavailable For Legal Reasons", 500: "Internal Server Error",
    501: "Not Implemented", 502: "Bad Gateway", 503: "Service Unavailable", 504: "Gateway Timeout", 505: "HTTP Version Not Supported", 506: "Variant Also Negotiates", 507: "Insufficient Storage",
    508: "Loop Detected", 510: "Not Extended", 511: "Network Authentication Required",
}
# End of fixed values.


def status_markers() -> list[str]:
    return [f"{code} {reason}" for code, reason in STATUS_REASONS.items()]


def markers() -> list[str]:
    return BOILERPLATE + status_markers()


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once; named in a lambda of its own, an expression is computed per element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def contains_any(text: Column, phrases: Iterable[str]) -> Column:
    """True if a phrase occurs in the text, case-sensitively."""
    return reduce(or_, (text.contains(p) for p in phrases), F.lit(False))


def has_status(text: Column) -> Column:
    """True if a status code and its reason occur; one pass whose look-ahead fails at once nearly everywhere."""
    return text.rlike("(?=[45][0-9]{2} )(?:" + "|".join(map(re.escape, status_markers())) + ")")


def rejected(text: Column, extra: Iterable[str] = ()) -> Column:
    """True if the text holds a marker of ``markers()`` or one of ``extra`` (such as ``FAILED_REQUEST``)."""
    return contains_any(text, [*BOILERPLATE, *extra]) | has_status(text)


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+\z", "")


def fold(text: Column) -> Column:
    """Ellipses to dots, long runs of space to three spaces, long runs of dots to three dots."""
    t = F.replace(text, F.lit("…"), F.lit("."))
    t = F.regexp_replace(t, SPACE + "{6,}", "   ")
    return F.regexp_replace(t, r"\.{6,}", "...")


def acceptable(text: Column) -> Column:
    """True for a text without markers of at least 3 characters when stripped; folding leaves no text shorter than that."""
    return ~rejected(text) & text.rlike(f"(?s){NO_SPACE}.+?{NO_SPACE}")


def clean(text: Column) -> Column:
    """A document as it is kept; null if it is not acceptable.

    Filter on ``acceptable`` before, where rows go: a filter on this column would evaluate all of it twice.
    """
    return F.when(acceptable(text), fold(strip(text)))


def clean_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    return docs.where(acceptable(F.col(text))).withColumn(text, fold(strip(F.col(text))))


def keep_lines(text: Column, least: int = 50, phrases: Iterable[str] = ()) -> Column:
    """Lines longer than ``least`` without any of the phrases, joined again."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: (F.length(x) > least) & ~contains_any(x, phrases)), "\n")


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def unique_ratio(text: Column) -> Column:
    return let(tokens(text), lambda w: F.when(F.size(w) > 0, F.size(F.array_distinct(w)) / F.size(w)))


def question_rejected(q: Column) -> Column:
    bad = contains_any(q, ["'", '"', "http", "\n", "[", "]", "/", "`"])
    return F.coalesce(bad | q.rlike(r"[^\x00-\x7f]") | q.rlike("[0-9]") | (F.length(q) < 20) | (F.length(q) > 200), F.lit(True))


def answer_rejected(a: Column) -> Column:
    return F.coalesce(a.contains("------"), F.lit(True))


def in_range(text: Column, ranges: Iterable[tuple[int, int]]) -> Column:
    """True if a code point of the text lies in one of the ranges."""
    return text.rlike("[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]")


TAMIL = [(0x0B80, 0x0BFF)]
HAN = [(0x4E00, 0x9FFF), (0x3400, 0x4DBF), (0x20000, 0x2EBEF)]


def prefix_key(text: Column) -> Column:
    """The beginning of a turn, normalised for comparison."""
    t = F.lower(F.substring(text, 1, 20))
    t = F.regexp_replace(F.regexp_replace(t, "[^a-z ]+", " "), " {2,}", " ")
    return F.substring(strip(t), 1, 10)


def replace_chain(text: Column, pairs: Iterable[tuple[str, str]]) -> Column:
    return reduce(lambda t, p: F.replace(t, F.lit(p[0]), F.lit(p[1])), pairs, text)


def normalize_line(text: Column) -> Column:
    t = F.regexp_replace(F.lower(strip(text)), r"\p{Nd}", "0")
    return F.regexp_replace(t, r"[\p{P}\p{C}\p{S}]+", "")


def remove_punctuation(text: Column) -> Column:
    return F.translate(text, "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", "")


def last_line(text: Column) -> Column:
    return F.element_at(F.split(text, "\n"), -1)


def but_last_line(text: Column) -> Column:
    lines = F.split(text, "\n")
    return F.array_join(F.slice(lines, F.lit(1), F.size(lines) - 1), "\n")


def after_marker(text: Column, marker: str, tail: int) -> Column:
    """What follows the first marker, stripped, without its last ``tail`` characters."""
    t = strip(F.element_at(F.split(text, re.escape(marker)), 2))
    return F.substring(t, F.lit(1), F.greatest(F.length(t) - tail, F.lit(0)))


def speech_text(text: Column) -> Column:
    t = F.translate(text, "!'\"", ".")
    return F.concat(F.lit(". "), strip(F.regexp_replace(t, " {2,}", " ")))


def with_stop(text: Column) -> Column:
    return F.when(text.endswith(". "), text).when(text.endswith("."), F.concat(text, F.lit(" "))).otherwise(F.concat(text, F.lit(". ")))


def chunks(text: Column, size: int = 500) -> Column:
    """Runs of ``size`` words, joined by single spaces; none for a text without words."""
    def cut(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(w) / size).cast("int") - 1, F.lit(0)))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(F.transform(starts, lambda k: F.array_join(F.slice(w, k * size + 1, size), " ")))

    return let(tokens(text), cut)


def shingle_tokens(text: Column) -> Column:
    """Split at each single non-word character; empty tokens stay."""
    return F.split(text, r"[^\p{L}\p{N}_]")


def ngrams(toks: Column, n: int = 5, min_length: int = 5) -> Column:
    """Distinct lower-cased n-grams; a short list gives one short gram, one below ``min_length`` none."""
    def grams(w: Column) -> Column:
        full = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.lower(F.array_join(F.slice(w, i, n), " ")))
        return F.when(F.size(w) < min_length, F.array().cast("array<string>")).when(F.size(w) < n, F.array(F.lower(F.array_join(w, " ")))).otherwise(full)

    return F.array_distinct(let(toks, grams))


def char_ngrams(text: Column, n: int) -> Column:
    """Distinct n-grams of code points. The text is taken apart once, as finding a place in it takes its whole length."""
    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    grams = let(chars, lambda c: F.transform(F.sequence(F.lit(1), F.size(c) - (n - 1)), lambda i: F.array_join(F.slice(c, i, n), "")))
    return F.array_distinct(F.when(F.length(text) < n, F.array(text)).otherwise(grams))


def jaccard(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.greatest(F.size(F.array_union(a, b)), F.lit(1))


def sha1_low(text: Column, bits: int = 32) -> Column:
    """The first ``bits`` of SHA-1 as a little-endian number."""
    h = F.sha1(text)
    rev = F.concat(*[F.substring(h, 2 * i + 1, 2) for i in reversed(range(bits // 8))])
    return F.conv(rev, 16, 10).cast("decimal(20,0)")


def transcript_rejected(text: Column, other: Column) -> Column:
    """True if a transcript closes like a video, or either side has fewer than 10 characters or too few different words."""
    ratio = F.least(unique_ratio(text), unique_ratio(other))
    bad = contains_any(F.lower(text), CLOSING_PHRASES) | (F.length(text) < 10) | (F.length(other) < 10) | (ratio < 0.5)
    return F.coalesce(bad, F.lit(True))


def has_fence(text: Column) -> Column:
    return F.coalesce(text.contains("```"), F.lit(False))


def scores_accepted(scores: Column, threshold: float = -15.0) -> Column:
    """True if no score is at or below the threshold."""
    return ~F.exists(scores, lambda s: s <= threshold)


def titled(title: Column, body: Column) -> Column:
    """Title, blank line, body; null if either is null."""
    return F.concat(title, F.lit("\n\n"), body)


def base_name(path: Column) -> Column:
    return F.regexp_extract(path, "([^/]*)$", 1)


def rebased(root: str, path: Column) -> Column:
    """The path below ``root``; an absolute path stays."""
    return F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root.rstrip("/") + "/"), path))


def numeric_suffix(name: Column) -> Column:
    """The number behind the last ``-`` of a name, for sorting shards."""
    return F.regexp_extract(name, r"-([0-9]+)$", 1).try_cast("long")


def rms_gain(samples: Column, least: float = 0.1) -> Column:
    """The factor that lifts samples to the least root mean square; 1 for louder ones, null for silence or no samples."""
    rms = F.sqrt(F.aggregate(samples, F.lit(0.0), lambda a, x: a + x * x) / F.size(samples))
    return F.when((F.size(samples) > 0) & (rms > 0), F.greatest(F.lit(least) / rms, F.lit(1.0)))


def speech_frames(frames: Column, reference: Column, speech: Column, speed: float = 1.0) -> Column:
    """Frames that the speech takes if it is spoken as the reference is, by UTF-8 bytes."""
    return F.floor(frames / F.octet_length(reference) * F.octet_length(speech) / speed).cast("long")


def megabytes(size: Column) -> Column:
    return F.format_string("%.2f MB", size / F.lit(1024.0 * 1024.0))


def xxh3(text: Column, bits: int = 64, seed: int = 0) -> Column:
    """The low ``bits`` (16, 32 or 64, unsigned) of XXH3 of the text, or all 128 as a decimal; a null text is empty."""
    import xxhash

    whole = xxhash.xxh3_128_intdigest if bits == 128 else xxhash.xxh3_64_intdigest
    mask, unsigned_seed = (1 << bits) - 1, seed % (1 << 64)

    @F.pandas_udf("string")
    def digest(t: pd.Series) -> pd.Series:
        return t.map(lambda x: str(whole((x or "").encode(), seed=unsigned_seed) & mask))

    return digest(text) if bits == 128 else digest(text).cast("decimal(20,0)")
