"""ANSI/DuckDB SQL text of the engine's expressions, for the oracle queries.

These strings are what ``oracle_sql()`` hands to DuckDB; they restate the
semantics of :mod:`sentispark.functions.text` independently (DuckDB uses RE2
with the ``'g'`` flag and ``\\1`` back-references).
"""

from __future__ import annotations

from sentispark.functions import text as T
from sentispark.sources.tables import ALL_CORPUS_SQL, RAW_CORPUS_SQL


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rx(expr: str, pattern: str, repl: str) -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(repl)}, 'g')"


def _cp_char(n: str) -> str:
    return (f"chr(CASE WHEN {n} BETWEEN 1 AND 1114111 AND NOT ({n} BETWEEN 55296 AND 57343) "
            f"THEN {n} ELSE 65533 END)")


def decode_entity_steps() -> list:
    """Entity decoding as a list of one-argument templates (``{t}`` = input);
    each step is applied in its own CTE so no expression text is repeated.  The
    text is cut at its references, they are mapped, the pieces are joined."""
    cut = (f"struct_pack(p := string_split_regex({{t}}, {q(T.REFERENCE)}), r := regexp_extract_all({{t}}, {q(T.REFERENCE)}))")
    names = " ".join(f"WHEN {q('&' + name)} THEN {q(ch)}" for name, ch in (("amp", "&"), *T.HTML_ENTITIES_LEGACY, *T.HTML_ENTITIES))
    dec = _cp_char("TRY_CAST(substr(rtrim(e, ';'), 3) AS INTEGER)")
    hexc = _cp_char("TRY_CAST('0x' || substr(rtrim(e, ';'), 4) AS INTEGER)")
    decode = (f"list_transform({{t}}.r, lambda e: CASE WHEN e[1:3] IN ('&#x', '&#X') THEN {hexc} "
              f"WHEN e[1:2] = '&#' THEN {dec} ELSE CASE rtrim(e, ';') {names} ELSE ' ' END END)")
    join = ("array_to_string(list_transform(range(1, len({t}.p) + 1), lambda i: {t}.p[i] || coalesce({t}.r[i], '')), '')")
    return [cut, f"struct_pack(p := {{t}}.p, r := {decode})", join]


def strip_tags(x: str) -> str:
    x = rx(x, T.COMMENT_RE, "")
    x = rx(x, T.SCRIPT_STYLE_RE, "")
    x = rx(x, T.DECL_RE, "")
    return rx(x, T.TAG_RE, "")


def staged(name: str, src: str, keep: str, text_expr: str, steps: list) -> list:
    """CTEs ``name_0 .. name`` applying templates in order to column ``t``."""
    ctes = [f"{name}_0 AS (SELECT {keep}, {text_expr} AS t FROM {src})"]
    prev = f"{name}_0"
    for k, st in enumerate(steps, 1):
        cur = name if k == len(steps) else f"{name}_{k}"
        ctes.append(f"{cur} AS (SELECT {keep}, {st.replace('{t}', 't')} AS t FROM {prev})")
        prev = cur
    return ctes


def strip_html_steps() -> list:
    return [strip_tags("{t}")] + decode_entity_steps()


def clean_steps(compat: bool = True, html: bool = True) -> list:
    steps = strip_html_steps() if html else []
    x = strip_bom("{t}")
    x = strip_mentions_urls(x)
    x = strip_www(x, compat)
    steps.append(f"lower({x})")
    steps.append(expand_negations("{t}"))
    steps.append(tokenize_min2(letters_only("{t}")))
    return steps


def strip_bom(x: str) -> str:
    return f"replace(replace({x}, chr(65279), ''), chr(65533), '?')"


def strip_mentions_urls(x: str) -> str:
    return rx(x, T.MENTION_OR_URL, "")


def strip_www(x: str, compat: bool = True) -> str:
    return rx(x, T.WWW_COMPAT if compat else T.WWW_STRICT, "")


def expand_negations(x: str) -> str:
    chain = x
    for key, rep in T.NEGATIONS:
        chain = rx(chain, r"\b" + key + r"\b", rep)
    return f"CASE WHEN contains({x}, {q(chr(110) + chr(39) + 't')}) THEN {chain} ELSE {x} END"


def letters_only(x: str) -> str:
    return rx(x, "[^a-zA-Z]", " ")


def tokens_min2(x: str) -> str:
    return f"list_filter(string_split_regex({x}, ' +'), lambda w: length(w) > 1)"


def tokenize_min2(x: str) -> str:
    return f"array_to_string({tokens_min2(x)}, ' ')"


def whitespace_tokens(x: str) -> str:
    t = f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
    return f"CASE WHEN {t} = '' THEN []::VARCHAR[] ELSE string_split({t}, ' ') END"


def normalize_review(x: str) -> str:
    return rx(f"replace(lower({x}), '<br />', ' ')", r'([.",()!?;:])', r" \1 ")


def not_empty(x: str) -> str:
    lits = ", ".join(q(s) for s in T.NA_LITERALS)
    return f"({x} IS NOT NULL AND trim({x}) <> '' AND {x} NOT IN ({lits}))"


def label01(x: str = "target") -> str:
    return f"CAST(CASE WHEN {x} > 0 THEN 1 ELSE 0 END AS INTEGER)"


# Shared CTEs ---------------------------------------------------------------
CORPUS = f"corpus AS ({RAW_CORPUS_SQL})"
CLEAN = ",\n".join(staged("clean", "corpus", "row_id, target", "text", clean_steps()))
CLEAN_NN = (f"clean_nn AS MATERIALIZED (SELECT row_id, t AS text, target FROM clean "
            f"WHERE {not_empty('t')})")
TOKENS = ("tokens AS (SELECT row_id, target, unnest(string_split(text, ' ')) AS term "
          "FROM clean_nn)")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE = with_(CORPUS, CLEAN, CLEAN_NN)
BASE_TOKENS = with_(CORPUS, CLEAN, CLEAN_NN, TOKENS)

# The same over all documents, labelled or not, for queries that read no label.
ALL_CORPUS = f"corpus AS ({ALL_CORPUS_SQL})"
ALL_BASE = with_(ALL_CORPUS, CLEAN, CLEAN_NN)
ALL_TOKENS = with_(ALL_CORPUS, CLEAN, CLEAN_NN, TOKENS)
