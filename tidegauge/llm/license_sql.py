"""The SQL that checks the licence scan: all known texts, made from the same lists by joins, and the
normalisation in the words of an engine whose patterns cannot look ahead."""

from __future__ import annotations

from tidegauge.llm import license_texts

_NO_WORD = r"[^\p{L}\p{N}]"
_WORD_ENDS = rf"(?:$|{_NO_WORD})"
#: A word that ends here and is not followed by a colon.
_NO_COLON = r"(?:$|[^\p{L}\p{N} \t:]|[ \t]+(?:$|[^ \t:]))"
_COPYRIGHT = rf"^{_NO_WORD}*copyright"
_SIGN = rf"^{_NO_WORD}*\([ \t]*c[ \t]*\)"
_PROSE = (
    rf"(?:[\"”.]|-[\p{{L}}-]|[ \t,]+(?:(?:holders?|owners?|notices?|statements?){_NO_COLON}"
    r"|(?:laws?|interests?|disclaimers?|permissions?|licen[cs]es?|treaty|treaties|ownership|doctrines|line|patents?"
    rf"|resulting|including|and|or|on|if|is|are|of this|the (?:software|library|program)){_WORD_ENDS}))"
)
_SIGN_PROSE = rf"[ \t]+(?:you|under|representations|the licen[cs]es){_WORD_ENDS}"
_RESERVED = rf"^{_NO_WORD}*all{_NO_WORD}+rights{_NO_WORD}+reserved{_WORD_ENDS}"


def _is_copyright_line(line: str) -> str:
    def found(pattern):
        return f"regexp_matches({line}, '{pattern}')"

    return (
        f"(({found(_COPYRIGHT + _WORD_ENDS)} AND NOT {found(_COPYRIGHT + _PROSE)})"
        f" OR ({found(_SIGN)} AND NOT {found(_SIGN + _SIGN_PROSE)})"
        f" OR {found(f'^{_NO_WORD}*©')} OR {found(_RESERVED)})"
    )


def _normal(text: str) -> str:
    """The normalised lines of a text."""
    kept = (
        f"array_to_string(list_transform(string_split(lower({text}), chr(10)), lambda l: "
        f"CASE WHEN {_is_copyright_line('l')} THEN '' ELSE l END), chr(10))"
    )
    words = rf"regexp_replace({kept}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    apart = f"concat(' ', replace(replace({words}, chr(10), concat(' ', chr(10), ' ')), ' ', '  '), ' ')"
    for spelled, common in license_texts.SPELLINGS:
        apart = f"replace({apart}, ' {spelled} ', ' {common} ')"
    return f"list_transform(string_split(replace({apart}, '  ', ' '), chr(10)), lambda l: trim(l))"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _rows(rows) -> str:
    return ", ".join("({})".format(", ".join(map(_quoted, row))) for row in rows)


def _known() -> str:
    """Licence and text of all that is known."""
    long = dict.fromkeys(license_texts.whole_texts() + license_texts.headers())
    ids = license_texts.listed("spdx_ids.txt")
    exceptions = license_texts.listed("spdx_exceptions.txt")
    return f"""
        WITH long AS (SELECT * FROM (VALUES {_rows(long)}) t(license_id, text)),
        named AS (SELECT * FROM (VALUES {_rows(license_texts.names())}) t(license_id, name)),
        verbs AS (SELECT * FROM (VALUES ('licensed'), ('released'), ('distributed')) t(verb)),
        subjects AS (
            SELECT '' AS subject UNION ALL
            SELECT concat('This ', thing, ' is ') FROM (VALUES {_rows((x,) for x in license_texts.SUBJECTS)}) t(thing)),
        articles AS (SELECT * FROM (VALUES (''), ('the '), ('the terms of the '), ('a ')) t(article)),
        spdx AS (SELECT * FROM (VALUES {_rows((x,) for x in ids)}) t(id)),
        exceptions AS (SELECT * FROM (VALUES {_rows((x,) for x in exceptions)}) t(exception)),
        usual AS (SELECT * FROM (VALUES {_rows((x,) for x in license_texts.USUAL)}) t(id))
        SELECT * FROM (VALUES {_rows(license_texts.KNOWN)}) t(license_id, text)
        UNION ALL SELECT * FROM long
        UNION ALL SELECT license_id, replace(text, 'http://', 'https://') FROM long
        UNION ALL SELECT license_id, replace(text, 'https://', 'http://') FROM long
        UNION ALL SELECT license_id, concat(subject, verb, ' under ', article, name, '.')
            FROM named, subjects, verbs, articles WHERE article <> 'a ' OR license_id LIKE 'CC-%'
        UNION ALL SELECT id, concat('SPDX-License-Identifier: ', id) FROM spdx
        UNION ALL SELECT concat(id, ' WITH ', exception), concat('SPDX-License-Identifier: ', id, ' WITH ', exception)
            FROM spdx, exceptions WHERE regexp_matches(id, '^([AL]?GPL-|Apache-2[.]0)')
        UNION ALL SELECT concat(least(a.id, b.id), ' ', word, ' ', greatest(a.id, b.id)),
                         concat('SPDX-License-Identifier: ', a.id, ' ', word, ' ', b.id)
            FROM usual a, usual b, (VALUES ('OR'), ('AND')) t(word) WHERE a.id <> b.id"""


def checking_sql() -> str:
    normal = _normal("coalesce(text, '')")
    return f"""
    WITH known AS (
        SELECT digest, min(license_id) AS license_id FROM (
            SELECT license_id, md5(array_to_string(list_filter(lines, lambda l: l <> ''), ' ')) AS digest
            FROM (SELECT license_id, {normal} AS lines FROM ({_known()})))
        GROUP BY digest),
    docs AS (
        SELECT doc_id, {normal} AS lines,
               list_transform(string_split(coalesce(text, ''), chr(10)), lambda l: trim(l)) AS raw
        FROM documents),
    units AS (
        SELECT doc_id, 'line' AS kind, unnest(list_filter(lines, lambda l: l <> '')) AS normal FROM docs
        UNION ALL
        SELECT doc_id, 'paragraph', array_to_string(list_filter(string_split(p, chr(10)), lambda l: l <> ''), ' ')
        FROM (SELECT doc_id, unnest(string_split(array_to_string(list_transform(lines, lambda l, i:
                  CASE WHEN raw[i] = '' THEN chr(12) ELSE l END), chr(10)), chr(12))) AS p FROM docs)
        WHERE instr(trim(p, chr(10)), chr(10)) > 0),
    hits AS (
        SELECT doc_id, count(*) AS notices, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS names
        FROM units JOIN known ON md5(normal) = digest GROUP BY doc_id)
    SELECT d.doc_id, d.text_digest, k.license_id AS text_license,
           coalesce(h.notices, 0) AS notices, h.names AS notice_licenses
    FROM (SELECT doc_id, md5(array_to_string(list_filter(lines, lambda l: l <> ''), ' ')) AS text_digest FROM docs) d
    LEFT JOIN known k ON k.digest = d.text_digest
    LEFT JOIN hits h ON h.doc_id = d.doc_id
    """
