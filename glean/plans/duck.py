"""DuckDB SQL text for the oracle twins of the Column kernels.

RE2 has no look-around, so line stripping is written with list functions;
everything else mirrors ``glean.functions`` one to one.
"""

from __future__ import annotations

from glean.functions import rules as R
from glean.functions.text import PY_WHITESPACE, PY_WHITESPACE_NO_NL


def chars(s: str) -> str:
    return "(" + "||".join(f"chr({ord(c)})" for c in s) + ")"


WS = chars(PY_WHITESPACE)
WS_NO_NL = chars(PY_WHITESPACE_NO_NL)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(e: str) -> str:
    return f"trim({e}, {WS})"


def rstrip_lines(e: str) -> str:
    return f"array_to_string(list_transform(string_split({e}, chr(10)), lambda x: rtrim(x, {WS_NO_NL})), chr(10))"


def collapse_newlines(e: str) -> str:
    return f"regexp_replace({e}, '\\n{{3,}}', chr(10) || chr(10), 'g')"


def blank_marked(e: str, marker: str, word: str) -> str:
    return f"regexp_replace({e}, {lit('(?im)^' + marker + '.*' + word + '.*$')}, '', 'g')"


def clean_code(e: str) -> str:
    e = collapse_newlines(e)
    e = rstrip_lines(e)
    e = blank_marked(e, "'", "copyright")
    e = blank_marked(e, "#", "copyright")
    return strip(e)


def contains_any(e: str, needles) -> str:
    return "(" + " or ".join(f"contains({e}, {lit(n)})" for n in needles) + ")"


def keywords_ok(code: str, language: str) -> str:
    return (f"(case when {language} = 'vbscript' then {contains_any(f'lower({code})', R.VBSCRIPT_KEYWORDS)} "
            f"when starts_with({language}, 'selenium') then {contains_any(code, R.SELENIUM_MARKERS)} "
            f"else true end)")


def length_ok(code: str, lo: int = R.MIN_CODE_CHARS, hi: int | None = R.MAX_CODE_CHARS) -> str:
    return f"(length({code}) >= {lo} and length({code}) <= {hi})" if hi is not None else f"(length({code}) >= {lo})"


def output_key(e: str) -> str:
    return f"md5(lower({strip(e)}))"


def task_label(text: str) -> str:
    folded = f"translate({text}, {lit(R.CASELESS_FROM)}, {lit(R.CASELESS_TO)})"
    parts = [f"when regexp_matches({folded}, {lit(p)}) then {lit(label)}" for p, label in R.TASK_RULES]
    parts += [f"when contains({text}, {lit(n)}) then {lit(label)}" for n, label in R.TASK_FALLBACKS]
    return "(case " + " ".join(parts) + f" else {lit(R.TASK_DEFAULT)} end)"


def task_of(code: str, description: str) -> str:
    return task_label(f"lower({code} || ' ' || coalesce({description}, ''))")


def _list(items) -> str:
    return "[" + ", ".join(lit(t) for t in items) + "]"


def templates_for(language: str) -> str:
    parts = [f"when {language} = {lit(k)} then {_list(v)}" for k, v in R.INSTRUCTION_TEMPLATES.items()]
    return "(case " + " ".join(parts) + f" else {_list(R.INSTRUCTION_TEMPLATES[R.DEFAULT_TEMPLATE_LANGUAGE])} end)"


def bucket(key: str, n: str) -> str:
    return f"(('0x' || substr({key}, 1, 8))::bigint % {n})"


def instruction_of(task: str, language: str, key: str) -> str:
    arr = templates_for(language)
    return f"replace(list_extract({arr}, {bucket(key, f'len({arr})')} + 1), '{{task}}', {task})"


def purpose_of(name: str) -> str:
    parts = [f"when contains(lower({name}), {lit(n)}) then {lit(label)}" for n, label in R.PURPOSE_RULES]
    pre, post = R.PURPOSE_DEFAULT.split("{name}")
    return "(case " + " ".join(parts) + f" else {lit(pre)} || {name} || {lit(post)} end)"


def language_from_tags(tags: str) -> str:
    parts = []
    for needles, label in R.TAG_LANGUAGE_RULES:
        cond = " or ".join(f"contains(t, {lit(n)})" for n in needles)
        parts.append(f"when len(list_filter({tags}, lambda t: {cond})) > 0 then {lit(label)}")
    return "(case " + " ".join(parts) + f" else {lit(R.TAG_LANGUAGE_DEFAULT)} end)"


def title_instruction(title: str) -> str:
    t = f"coalesce({title}, '')"
    return f"(case when ends_with({t}, '?') then {t} else 'How to ' || lower({t}) end)"


def lang_family(language: str) -> str:
    return f"regexp_replace({language}, '^selenium_', '')"


# --- HTML --------------------------------------------------------------------

SEP, OPEN, CLOSE, OPEN2, CLOSE2 = "chr(57344)", "chr(57345)", "chr(57346)", "chr(57347)", "chr(57348)"
TAG = "</?[A-Za-z][^>]*>"


def drop_ignorable(e: str, repl: str = "''") -> str:
    for p in [r"(?s)<!--.*?-->", r"(?is)<script\b[^>]*>.*?</script\s*>", r"(?is)<style\b[^>]*>.*?</style\s*>",
              r"<![^>]*>", r"<\?[^>]*>"]:
        e = f"regexp_replace({e}, {lit(p)}, {repl}, 'g')"
    return e


def unescape(e: str) -> str:
    from glean.functions.html import FAST_ENTITIES

    for k, v in FAST_ENTITIES[:-1]:
        e = f"replace({e}, {lit(k)}, chr({ord(v)}))"
    e = f"regexp_replace({e}, '&amp([^;]|$)', '&\\1', 'g')"
    return f"replace({e}, '&amp;', '&')"


def strip_tags(e: str) -> str:
    return f"regexp_replace({e}, {lit(TAG)}, '', 'g')"


def code_blocks_from(parts: str, min_len: int = 21) -> str:
    """Code block texts from ``parts`` = string_split(marked html, OPEN)."""
    suffix = (f"array_to_string(list_transform(list_slice({parts}, i, len({parts})), "
              f"lambda x: substr(x, strpos(x, {CLOSE}) + 1)), '')")
    name = f"lower(split_part({parts}[i], {CLOSE}, 1))"
    content = (f"(case when {name} = 'pre' then regexp_extract({suffix}, '(?is)^(.*?)(?:</pre\\s*>|$)', 1) "
               f"else regexp_extract({suffix}, '(?is)^(.*?)(?:</code\\s*>|$)', 1) end)")
    texts = f"list_transform(range(2, len({parts}) + 1), lambda i: {strip(unescape(strip_tags(content)))})"
    return f"list_filter({texts}, lambda t: length(t) >= {min_len})"


def mark_blocks(e: str) -> str:
    """string_split of the cleaned html at every pre/code opening tag."""
    cleaned = drop_ignorable(f"coalesce({e}, '')")
    marked = f"regexp_replace({cleaned}, '(?i)<(pre|code)\\b[^>]*>', {OPEN} || '\\1' || {CLOSE}, 'g')"
    return f"string_split({marked}, {OPEN})"


def _outside(o: str) -> str:
    return f"regexp_replace({o}, '(?:{TAG}|' || {SEP} || ')+', {SEP}, 'g')"


def _block(i: str) -> str:
    body = f"regexp_replace({i}, '{TAG}|' || {SEP}, '', 'g')"
    return f"({SEP} || chr(10) || '```' || chr(10) || {body} || chr(10) || '```' || chr(10) || {SEP})"


def _assemble(pieces: str, close: str, inner, v: str, k: str) -> str:
    """Text of a string_split at block openings: piece 1 is outside text, every
    later piece is "<block>CLOSE<outside>"; ``inner`` renders outside text.
    ``v``/``k`` name the lambda variables (distinct per nesting level)."""
    return (f"array_to_string(list_transform({pieces}, lambda {v}, {k}: case when {k} = 1 then {inner(v)} "
            f"else {_block(f'split_part({v}, {close}, 1)')} || {inner(f'substr({v}, strpos({v}, {close}) + 1)')} end), '')")


def _code_level(o: str) -> str:
    m = f"regexp_replace({o}, '(?is)<code\\b[^>]*>(.*?)(?:</code\\s*>|$)', {OPEN2} || '\\1' || {CLOSE2}, 'g')"
    return _assemble(f"string_split({m}, {OPEN2})", CLOSE2, _outside, "p2", "i2")


def html_to_text(e: str) -> str:
    h = drop_ignorable(f"coalesce({e}, '')", SEP)
    m = f"regexp_replace({h}, '(?is)<pre\\b[^>]*>(.*?)(?:</pre\\s*>|$)', {OPEN} || '\\1' || {CLOSE}, 'g')"
    body = _assemble(f"string_split({m}, {OPEN})", CLOSE, _code_level, "p1", "i1")
    t = f"regexp_replace({body}, {SEP} || '+', {SEP}, 'g')"
    t = f"replace(trim({t}, {SEP}), {SEP}, chr(10))"
    t = unescape(unescape(t))
    return strip(collapse_newlines(t))
