"""SQL restatements of the expressions, as fragments for the oracle queries.

RE2 has neither look-around nor Unicode classes for ``\\s`` and ``\\w``; the
fragments hold for the driver's tables, whose white space is space and line end
and whose other characters are Latin letters.
"""

from __future__ import annotations

from ..functions.subword import SHORT_WORDS as _SHORT
from ..operators.parse import ADPOSITIONS, CONJUNCTIONS, DETERMINERS, PRONOUNS

WORD = r"[\p{L}\p{N}_]"
_A, _B, _C = "chr(57344)", "chr(57345)", "chr(57346)"


def squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def basic(x: str, keep_case: bool = False, no_punct: bool = False) -> str:
    if no_punct:
        x = rf"regexp_replace({x}, '[^\p{{L}}\p{{N}}_\s]', ' ', 'g')"
    return squeeze(x if keep_case else f"lower({x})")


def to_ascii(x: str) -> str:
    return rf"regexp_replace(strip_accents({x}), '[^\x00-\x7F]+', '', 'g')"


def abbreviations(x: str) -> str:
    """For lower-cased text, where no two spaces to insert can meet in one character."""
    out = rf"regexp_replace({x}, '(?i)\b(?:(fig\.)|(i\.e\.|i e )|(e\.g\.|e g )|(etc\.))\b', {_A}||'\1'||{_B}||'\2'||{_B}||'\3'||{_B}||'\4'||{_C}, 'g')"
    for k, words in enumerate(("figure", "that is", "for example", "etc")):
        out = f"regexp_replace({out}, {_A}||repeat({_B}, {k})||'[^'||{_A}||{_B}||{_C}||']+'||repeat({_B}, {3 - k})||{_C}, '{words}', 'g')"
    return rf"regexp_replace({out}, '([a-z,])([0-9])', '\1 \2', 'g')"


def level2(x: str) -> str:
    return abbreviations(to_ascii(basic(x)))


def pieces(x: str) -> str:
    return rf"string_split(regexp_replace(trim({x}, E' \n\t\r'), '([.!?])\s+', '\1'||chr(1), 'g'), chr(1))"


def sentences_of(p: str) -> str:
    """From a column of pieces."""
    return (
        f"list_filter(flatten(list_transform({p}, lambda x, i: CASE WHEN i < len({p}) AND regexp_matches(regexp_replace(x, '[.!?]+$', ''), '[.!?]') "
        f"THEN [rtrim(regexp_replace(x, '[.!?]+$', '')), regexp_extract(x, '[.!?]+$')] ELSE [x] END)), lambda x: x <> '')"
    )


def tokens(x: str, least: int = 0, most: int = 30) -> str:
    return f"list_filter(regexp_extract_all({x}, '{WORD}+'), lambda w: length(w) BETWEEN {least} AND {most})"


#: doc_id, sent_idx (from 0), s, t (tokens): all sentences of documents, cleaned twice.
SENTENCES = f"""
cleaned AS (SELECT doc_id, {pieces(level2("text"))} AS p FROM documents),
split AS (SELECT doc_id, {sentences_of("p")} AS r FROM cleaned),
rows AS (SELECT doc_id, unnest(r) AS raw, generate_subscripts(r, 1) - 1 AS sent_idx FROM split),
sents AS (SELECT doc_id, sent_idx, {level2("raw")} AS s FROM rows),
tokened AS (SELECT doc_id, sent_idx, s, {tokens("s")} AS t FROM sents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY sent_idx) AS rn FROM tokened WHERE len(t) BETWEEN 3 AND 50),
kept AS (SELECT * FROM ranked WHERE rn <= 10)
"""


def _in(words) -> str:
    return ", ".join(f"'{w}'" for w in words)


def tag(w: str) -> str:
    m = lambda p: f"regexp_matches(lower({w}), '{p}')"
    return (
        f"CASE WHEN {m('^[0-9]+$')} THEN 'NUM' WHEN NOT {m(r'[\p{L}\p{N}]')} THEN 'PUNCT' WHEN lower({w}) IN ({_in(DETERMINERS)}) THEN 'DET' "
        f"WHEN lower({w}) IN ({_in(ADPOSITIONS)}) THEN 'ADP' WHEN lower({w}) IN ({_in(PRONOUNS)}) THEN 'PRON' WHEN lower({w}) IN ({_in(CONJUNCTIONS)}) THEN 'CCONJ' "
        f"WHEN {m('..ly$')} THEN 'ADV' WHEN {m('..(ed|ing|es)$')} THEN 'VERB' WHEN {m('..(ble|ous|ful|ive)$')} THEN 'ADJ' ELSE 'NOUN' END"
    )


#: Of one and two letters.
SHORT_WORDS = _in(sorted(_SHORT))


def one_hot(x: str, names: tuple[str, ...]) -> str:
    """Zeros and a one, as a string; the last place is for values that aren't listed."""
    listed = "[" + ", ".join(f"'{n}'" for n in names) + "]"
    place = f"coalesce(nullif(list_position({listed}, {x}), 0) - 1, {len(names)})"
    return f"repeat('0', {place}) || '1' || repeat('0', {len(names)} - {place})"


#: One row a node of the rule parser's trees over the kept sentences.
RULE_NODES = f"""
tagged AS (SELECT doc_id, sent_idx, t, list_transform(t, lambda w: {tag("w")}) AS tags FROM kept),
rooted AS (SELECT *, coalesce(nullif(list_position(tags, 'VERB'), 0), 1) AS root FROM tagged),
nodes AS (SELECT doc_id, sent_idx, unnest(t) AS word, unnest(tags) AS pos, generate_subscripts(t, 1) AS idx, len(t) AS n, root FROM rooted),
headed AS (SELECT *, CASE WHEN idx = root THEN 0 WHEN pos IN ('DET', 'ADP', 'ADJ', 'NUM', 'CCONJ') AND idx < n THEN idx + 1 ELSE root END AS head,
  CASE WHEN idx = root THEN 'root' WHEN pos = 'DET' THEN 'det' WHEN pos = 'ADP' THEN 'case' WHEN pos = 'ADJ' THEN 'amod' WHEN pos = 'NUM' THEN 'nummod'
    WHEN pos = 'ADV' THEN 'advmod' WHEN pos = 'CCONJ' THEN 'cc' WHEN pos = 'PUNCT' THEN 'punct' WHEN pos = 'VERB' THEN 'conj' WHEN idx < root THEN 'nsubj' ELSE 'obj' END AS rel FROM nodes)
"""
