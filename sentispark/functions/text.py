"""Text scalar functions (T1-T20) as native Spark Column expressions.

Every function takes and returns a :class:`~pyspark.sql.Column`; nothing here
leaves the JVM, so a whole cleaning chain compiles into one codegen'd
Project next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------------
# Fixed values that must equal the original study's (cleaning step).
# Mention and link patterns, the 'www' pattern with its unescaped dot, and the
# seventeen negation contractions with their expansions, in the study's order.
MENTION_OR_URL = r"@[A-Za-z0-9_]+|https?://[^ ]+"
WWW_COMPAT = r"www.[^ ]+"
WWW_STRICT = r"\bwww\.[^ ]+"
NEGATIONS = (
    ("isn't", "is not"), ("aren't", "are not"), ("wasn't", "was not"),
    ("weren't", "were not"), ("haven't", "have not"), ("hasn't", "has not"),
    ("hadn't", "had not"), ("won't", "will not"), ("wouldn't", "would not"),
    ("don't", "do not"), ("doesn't", "does not"), ("didn't", "did not"),
    ("can't", "can not"), ("couldn't", "could not"), ("shouldn't", "should not"),
    ("mightn't", "might not"), ("mustn't", "must not"),
)
# Cleaned texts the CSV reader of the study turned into missing values.
NA_LITERALS = ("nan", "null")
# --------------------------------------------------------------------------

# Named HTML entities decoded by strip_html (all others become a blank).
# Entities in the first group are also recognised without the semicolon.
HTML_ENTITIES_LEGACY = (("lt", "<"), ("gt", ">"), ("quot", '"'), ("nbsp", "\u00a0"),
                        ("copy", "©"), ("reg", "®"))
HTML_ENTITIES = (("apos", "'"), ("middot", "·"), ("hellip", "…"),
                 ("mdash", "—"), ("ndash", "–"), ("laquo", "«"),
                 ("raquo", "»"), ("lsquo", "‘"), ("rsquo", "’"),
                 ("ldquo", "“"), ("rdquo", "”"), ("bull", "•"),
                 ("trade", "™"), ("euro", "€"), ("pound", "£"),
                 ("deg", "°"))
#: One reference: a legacy name with or without semicolon, or a name or number with one.
REFERENCE = ("&(?:(?:amp|" + "|".join(n for n, _ in HTML_ENTITIES_LEGACY) + ");?"
             "|#[0-9]{1,7};|#[xX][0-9a-fA-F]{1,6};|[A-Za-z][A-Za-z0-9]*;)")

COMMENT_RE = r"(?s)<!--.*?-->"
SCRIPT_STYLE_RE = r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
DECL_RE = r"<[!?][^>]*>"
TAG_RE = r"</?[A-Za-z][^>]*>"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable.

    A guard such as ``CASE WHEN contains(x, '&') THEN f(x) ELSE x`` repeats
    the subtree ``x``; nested guards would repeat it multiplicatively.  Binding
    ``x`` through a one-element ``transform`` keeps one copy."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _codepoint_char(cp: Column) -> Column:
    """Unicode character for an integer code point; invalid points -> U+FFFD."""
    ok = (cp >= 1) & (cp <= 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)
    cp = F.when(ok, cp).otherwise(F.lit(0xFFFD))
    return F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "utf-32")


def decode_entities(c: ColumnOrName) -> Column:
    """Decode HTML references in one pass from left to right: the text is cut at its references,
    each is mapped on its own and the pieces are joined, so what a reference decodes to is
    never read again (``&amp;lt;`` and ``&#38;lt;`` give ``&lt;``).  Texts without ``&`` skip it."""
    return let(_c(c), lambda v: F.when(v.contains("&"), _decode_entities(v)).otherwise(v))


def _decode_reference(ref: Column) -> Column:
    """The text of one match of ``REFERENCE``; names that are not in the tables are a blank."""
    body = F.rtrim(F.substring(ref, 2, 64), F.lit(";"))
    names = F.create_map(*[F.lit(x) for pair in (("amp", "&"), *HTML_ENTITIES_LEGACY, *HTML_ENTITIES) for x in pair])
    return (F.when(body.rlike("^#[xX]"), _codepoint_char(F.conv(F.substring(body, 3, 6), 16, 10).cast("int")))
            .when(body.startswith("#"), _codepoint_char(F.substring(body, 2, 7).cast("int")))
            .otherwise(F.coalesce(F.try_element_at(names, body), F.lit(" "))))


def _decode_entities(src: Column) -> Column:
    pieces = F.split(src, REFERENCE, -1)
    decoded = F.transform(F.regexp_extract_all(src, F.lit(REFERENCE), 0), _decode_reference)
    # one piece more than references: the last one meets a null
    return F.array_join(F.zip_with(pieces, decoded, lambda p, r: F.concat(p, F.coalesce(r, F.lit("")))), "")


def strip_html(c: ColumnOrName, decode: bool = True) -> Column:
    """Markup to text.  Tags go with no separator (``a<br>b`` -> ``ab``);
    comments and script/style bodies go whole; entities decoded once."""
    def tags(v: Column) -> Column:
        x = F.regexp_replace(v, COMMENT_RE, "")
        x = F.regexp_replace(x, SCRIPT_STYLE_RE, "")
        x = F.regexp_replace(x, DECL_RE, "")
        return F.regexp_replace(x, TAG_RE, "")
    # no '<': no markup to strip
    x = let(_c(c), lambda v: F.when(v.contains("<"), tags(v)).otherwise(v))
    return decode_entities(x) if decode else x


def strip_bom(c: ColumnOrName) -> Column:
    """Drop byte-order marks, show replacement characters as '?'."""
    return F.replace(F.translate(_c(c), "\ufeff", ""), F.lit("\ufffd"), F.lit("?"))


def strip_mentions_urls(c: ColumnOrName) -> Column:
    """Remove @mentions and http(s) links (a link ends at a space only)."""
    return F.regexp_replace(_c(c), MENTION_OR_URL, "")


def strip_www(c: ColumnOrName, compat: bool = True) -> Column:
    """T4: remove 'www' links; ``compat`` keeps the study's unescaped dot."""
    return F.regexp_replace(_c(c), WWW_COMPAT if compat else WWW_STRICT, "")


def lowercase(c: ColumnOrName) -> Column:
    """T5."""
    return F.lower(_c(c))


def expand_negations(c: ColumnOrName) -> Column:
    """The 17 contractions, word bounded.  Texts without ``n't`` skip the
    chain, so the common case costs one ``contains``."""
    def chain(v: Column) -> Column:
        for key, rep in NEGATIONS:
            v = F.regexp_replace(v, r"\b" + key + r"\b", rep)
        return v
    return let(_c(c), lambda v: F.when(v.contains("n't"), chain(v)).otherwise(v))


def letters_only(c: ColumnOrName) -> Column:
    """Every character outside ``[a-zA-Z]`` becomes a space."""
    return F.regexp_replace(_c(c), r"[^a-zA-Z]", " ")


def tokens_min2(c: ColumnOrName) -> Column:
    """Array of space-separated words longer than one character."""
    return F.filter(F.split(_c(c), " +"), lambda w: F.length(w) > 1)


def tokenize_min2(c: ColumnOrName) -> Column:
    """Tokenise, keep tokens longer than one character, join by a space."""
    return F.array_join(tokens_min2(c), " ")


def clean_text(c: ColumnOrName, compat: bool = True, html: bool = True) -> Column:
    """T1 -> T2 -> T3 -> T4 -> T5 -> T6 -> T7 -> T8 as one expression."""
    x = _c(c)
    if html:
        x = strip_html(x)
    x = strip_bom(x)
    x = strip_mentions_urls(x)
    x = strip_www(x, compat)
    x = lowercase(x)
    x = expand_negations(x)
    x = letters_only(x)
    return tokenize_min2(x)


def whitespace_tokens(c: ColumnOrName) -> Column:
    """``str.split()`` -- runs of whitespace, no empty tokens."""
    x = F.trim(F.regexp_replace(_c(c), r"\s+", " "))
    return F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, " "))


def normalize_review(c: ColumnOrName) -> Column:
    """Lower, ``<br />`` -> space, pad ``. " , ( ) ! ? ; :`` with spaces."""
    x = F.replace(F.lower(_c(c)), F.lit("<br />"), F.lit(" "))
    return F.regexp_replace(x, r'([.",()!?;:])', " $1 ")


def replace_control(c: ColumnOrName) -> Column:
    """U+0085 (next line) -> space."""
    return F.translate(_c(c), "\u0085", " ")


def path_to_name(c: ColumnOrName) -> Column:
    """``train/pos`` -> ``train-pos.txt``."""
    return F.concat(F.replace(_c(c), F.lit("/"), F.lit("-")), F.lit(".txt"))


def word_count(c: ColumnOrName) -> Column:
    """Number of whitespace-separated words."""
    return F.size(whitespace_tokens(c))


def vectorizer_tokens(c: ColumnOrName) -> Column:
    """Lower-cased tokens of two or more word characters."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(r"\b\w\w+\b"), 0)


def ngrams(tokens: ColumnOrName, n_max: int = 1, n_min: int = 1) -> Column:
    """All n-grams for n in [n_min, n_max], grouped by n, in text order.

    Built from shifted slices joined pairwise by ``zip_with`` -- each array
    argument is evaluated once per row, so the cost is linear in the text
    length (a ``slice`` inside a ``transform`` lambda would re-evaluate the
    token expression per element).
    """
    t = _c(tokens)
    empty = F.array().cast("array<string>")

    def first(arr: Column, k: Column) -> Column:
        return F.when(k > 0, F.slice(arr, 1, k)).otherwise(empty)

    parts = []
    g = t  # n-grams of the current order, aligned at their first word
    for n in range(1, n_max + 1):
        if n > 1:
            k = F.size(t) - n + 1
            shifted = F.when(k > 0, F.slice(t, n, k)).otherwise(empty)
            g = F.zip_with(first(g, k), shifted, lambda a, b: F.concat(a, F.lit(" "), b))
        if n >= n_min:
            parts.append(g)
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def tag_document(words: ColumnOrName, key: ColumnOrName, prefix: str = "all") -> Column:
    """``struct(words, tag)`` with tag ``<prefix>_<key>``."""
    return F.struct(_c(words).alias("words"),
                    F.concat(F.lit(prefix + "_"), _c(key).cast("string")).alias("tag"))


def percent(c: ColumnOrName, digits: int = 2) -> Column:
    """Share as a percentage rounded for reports."""
    return F.round(_c(c) * 100.0, digits)


def is_empty_text(c: ColumnOrName, na_literals: bool = True) -> Column:
    """True for null, blank, and (optionally) the CSV missing-value literals."""
    x = _c(c)
    cond = x.isNull() | (F.trim(x) == "")
    if na_literals:
        cond = cond | x.isin(*NA_LITERALS)
    return cond
