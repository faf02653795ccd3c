"""Rule tables and their compilation to Column expressions.

The tables are data: callers may pass their own. The defaults below are the
fixed values the corpus semantics depend on; they must stay exactly as they
are (order is semantics: the first matching rule wins).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glean.functions.text import col_of, contains_any, py_search

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference behaviour; natural order, unchanged)
# ---------------------------------------------------------------------------

# Task detection: (regex searched in lower(code + " " + description), task).
TASK_RULES = [
    (r"click.*button", "click a button"),
    (r"enter.*text|input.*value|set.*field", "enter text into a field"),
    (r"select.*dropdown|choose.*option", "select from a dropdown"),
    (r"verify.*element|check.*exist", "verify an element exists"),
    (r"wait.*element|wait.*load", "wait for an element"),
    (r"login|sign.?in", "handle user login"),
    (r"logout|sign.?out", "handle user logout"),
    (r"table.*row|iterate.*table", "work with table data"),
    (r"screenshot|capture", "take a screenshot"),
    (r"file.*upload|upload.*file", "upload a file"),
    (r"download|save.*file", "download a file"),
    (r"navigate|goto|open.*url", "navigate to a URL"),
    (r"frame|iframe|switch.*frame", "handle iframes"),
    (r"window|tab|switch.*window", "handle multiple windows"),
    (r"alert|popup|dialog", "handle alerts/dialogs"),
    (r"drag.*drop", "perform drag and drop"),
    (r"scroll", "scroll the page"),
    (r"hover|mouse.*over", "hover over an element"),
    (r"right.?click|context.*menu", "perform right-click"),
    (r"double.?click", "perform double-click"),
    (r"keyboard|key.*press|send.*keys", "simulate keyboard input"),
    (r"cookie", "handle cookies"),
    (r"excel|spreadsheet", "work with Excel data"),
    (r"database|sql|query", "interact with database"),
    (r"api|rest|http", "make API calls"),
    (r"json|parse", "handle JSON data"),
    (r"xml", "handle XML data"),
    (r"regex|pattern", "use regular expressions"),
    (r"error.*handling|try.*catch", "handle errors"),
    (r"log|report", "log or report results"),
    (r"parallel|concurrent", "run tests in parallel"),
    (r"data.*driven|parameterize", "implement data-driven testing"),
]
# Fallbacks when no rule matches: substring -> task, then the final default.
TASK_FALLBACKS = [("test", "automate testing"), ("function", "create a reusable function")]
TASK_DEFAULT = "automate a task"

# Instruction templates per language; unknown languages use "vbscript".
INSTRUCTION_TEMPLATES = {
    "vbscript": [
        "Write VBScript code to {task}",
        "Create a UFT VBScript function that {task}",
        "Implement VBScript automation for {task}",
        "Generate UFT script to {task}",
        "Write QTP VBScript code that {task}",
    ],
    "selenium_python": [
        "Write Selenium Python code to {task}",
        "Create a Selenium WebDriver script that {task}",
        "Implement browser automation in Python to {task}",
        "Generate Selenium pytest code to {task}",
        "Write Python automation code that {task}",
    ],
    "selenium_java": [
        "Write Selenium Java code to {task}",
        "Create a Selenium WebDriver test in Java that {task}",
        "Implement browser automation in Java to {task}",
    ],
    "selenium_javascript": [
        "Write Selenium JavaScript code to {task}",
        "Create a WebDriverIO script that {task}",
        "Implement browser automation in Node.js to {task}",
    ],
}
DEFAULT_TEMPLATE_LANGUAGE = "vbscript"

# Code validation.
MIN_CODE_CHARS = 50
MAX_CODE_CHARS = 10000
VBSCRIPT_KEYWORDS = ["function", "sub", "dim", "set", "if", "for", "while", "browser", "window"]
SELENIUM_MARKERS = ["selenium", "webdriver", "driver", "find_element", "By."]

# Repository file selection.
FILE_EXTENSIONS = {
    "vbscript": [".vbs", ".qfl", ".mts"],
    "python": [".py"],
    "java": [".java"],
    "javascript": [".js", ".ts"],
}
MAX_FILE_BYTES = 100000
SELENIUM_CONTENT_MARKERS = ["selenium", "webdriver"]

# Q&A tag -> language (first match wins; default selenium_python).
TAG_LANGUAGE_RULES = [
    (["vbscript", "uft", "qtp"], "vbscript"),
    (["python"], "selenium_python"),
    (["java"], "selenium_java"),
]
TAG_LANGUAGE_DEFAULT = "selenium_python"

# Q&A categories and the tags searched for each, in search order.
QA_CATEGORY_TAGS = {
    "vbscript": ["vbscript", "qtp", "uft", "hp-uft", "microfocus-uft", "vbscript-automation"],
    "selenium": ["selenium", "selenium-webdriver", "selenium-python", "selenium-java",
                 "selenium-chromedriver", "webdriver", "python-selenium"],
}

# Function purpose from its name (first substring found in lower(name)).
PURPOSE_RULES = [
    ("login", "handle user login"),
    ("logout", "handle user logout"),
    ("click", "click an element"),
    ("enter", "enter data into a field"),
    ("input", "input data"),
    ("select", "select from a dropdown"),
    ("verify", "verify an element or value"),
    ("check", "check a condition"),
    ("validate", "validate data"),
    ("wait", "wait for an element or condition"),
    ("get", "get a value or element"),
    ("set", "set a value"),
    ("read", "read data"),
    ("write", "write data"),
    ("export", "export data"),
    ("import", "import data"),
    ("navigate", "navigate to a page"),
    ("open", "open an application or page"),
    ("close", "close an application or window"),
    ("search", "search for an item"),
    ("filter", "filter data"),
    ("sort", "sort data"),
    ("save", "save data"),
    ("delete", "delete an item"),
    ("update", "update data"),
    ("create", "create a new item"),
    ("table", "handle table operations"),
    ("row", "process table rows"),
    ("cell", "handle table cells"),
    ("error", "handle errors"),
    ("log", "log information"),
    ("report", "report results"),
]
PURPOSE_DEFAULT = "perform {name} operation"

# Script component patterns (case-insensitive).
FUNCTION_PATTERN = r"(?:Public\s+|Private\s+)?(?:Function|Sub)\s+(\w+)\s*\((.*?)\)(.*?)End\s+(?:Function|Sub)"
OBJECT_TYPES = ["Browser", "Window", "Dialog", "Page", "Frame", "WebButton", "WebEdit", "WebList",
                "WebTable", "WebElement", "WinButton", "WinEdit", "WinList", "WinObject",
                "SwfWindow", "SwfButton", "SwfEdit"]
OBJECT_PATTERN = r"(" + "|".join(OBJECT_TYPES) + r")\s*\(\s*\"([^\"]+)\"\s*\)"
CHECKPOINT_PATTERN = r"\.Check\s*\(\s*Checkpoint\s*\(\s*\"([^\"]+)\"\s*\)\s*\)"
DATATABLE_PATTERN = (r"DataTable(?:\.Value)?\s*\(\s*\"([^\"]+)\""
                     r"(?:\s*,\s*(?:dtGlobalSheet|dtLocalSheet|\"[^\"]+\"))?\s*\)")
REPORTER_PATTERN = r"Reporter\.ReportEvent\s+(\w+)\s*,\s*\"([^\"]+)\"\s*,\s*\"([^\"]+)\""

# Object-repository strings: printable ASCII runs of at least 4, kept when
# they mention one of these words (lower-cased).
OBJECT_STRING_KEYWORDS = ["browser", "window", "page", "button", "edit", "list"]

# Sample generation from projects.
ACTION_MIN_CHARS = 100      # strictly greater
FUNCTION_MIN_CHARS = 50     # strictly greater
OBJECTS_IN_INPUT = 5

# Augmentation: (old, new) replacements; each adds one variant when it changes the text.
AUGMENT_REWRITES = [("Write", "Create")]

# Split and volume.
VAL_RATIO = 0.05
LOW_VOLUME = 1000

# ---------------------------------------------------------------------------
# Compilation to Columns
# ---------------------------------------------------------------------------


# After lower(), Python's IGNORECASE matching of ASCII pattern letters adds only
# these equivalences (dotless i ~ i, long s ~ s); folding them once lets the
# rule patterns run case-sensitively, which is much cheaper than (?iu).
CASELESS_FROM, CASELESS_TO = "\u0131\u017f", "is"


def caseless(text) -> Column:
    return F.translate(col_of(text), CASELESS_FROM, CASELESS_TO)


def required_literals(pattern: str):
    """Literal pieces a match must contain, per alternation branch, or None.

    Only for patterns made of plain words joined by ``.*``/``.?`` and ``|``
    (every default rule); anything else returns None and skips the pre-check.
    """
    import re

    branches = []
    for branch in pattern.split("|"):
        pieces = [p for p in re.split(r"\.\*|\.\?", branch) if p]
        if not pieces or any(not re.fullmatch(r"[a-z0-9 _-]+", p) for p in pieces):
            return None
        branches.append(pieces)
    return branches


def literal_precheck(text, pattern: str):
    """A cheap necessary condition for ``pattern`` (substring tests), or None."""
    branches = required_literals(pattern)
    if branches is None:
        return None
    cond = None
    for pieces in branches:
        conj = None
        for p in pieces:
            t = F.contains(text, F.lit(p))
            conj = t if conj is None else (conj & t)
        cond = conj if cond is None else (cond | conj)
    return cond


def task_label(text, rules=TASK_RULES, fallbacks=TASK_FALLBACKS, default=TASK_DEFAULT, folded=None) -> Column:
    """First rule whose pattern is found in ``text`` (already lower-cased),
    as one CASE chain: a single projection inside codegen, no join.

    Each regex is guarded by a substring pre-check of its literals, so prose
    that cannot match a rule costs a few byte scans instead of a regex scan.
    """
    text = col_of(text)
    folded = caseless(text) if folded is None else folded
    chain = None
    for pattern, label in list(rules):
        cond = py_search(folded, pattern)
        pre = literal_precheck(folded, pattern)
        if pre is not None:
            cond = pre & cond
        chain = F.when(cond, label) if chain is None else chain.when(cond, label)
    for needle, label in fallbacks:
        cond = F.contains(text, F.lit(needle))
        chain = F.when(cond, label) if chain is None else chain.when(cond, label)
    return chain.otherwise(default) if chain is not None else F.lit(default)


def templates_for(language, templates=INSTRUCTION_TEMPLATES,
                  default_language=DEFAULT_TEMPLATE_LANGUAGE) -> Column:
    language = col_of(language)
    chain = None
    for lang, items in templates.items():
        arr = F.array(*[F.lit(t) for t in items])
        chain = F.when(language == lang, arr) if chain is None else chain.when(language == lang, arr)
    return chain.otherwise(F.array(*[F.lit(t) for t in templates[default_language]]))


def purpose_of(name, rules=PURPOSE_RULES, default=PURPOSE_DEFAULT) -> Column:
    name = col_of(name)
    low = F.lower(name)
    chain = None
    for needle, label in rules:
        cond = F.instr(low, needle) > 0
        chain = F.when(cond, label) if chain is None else chain.when(cond, label)
    pre, post = default.split("{name}")
    return chain.otherwise(F.concat(F.lit(pre), name, F.lit(post)))


def language_from_tag_array(tags, rules=TAG_LANGUAGE_RULES, default=TAG_LANGUAGE_DEFAULT) -> Column:
    tags = col_of(tags)
    chain = None
    def any_tag_has(needles):
        return F.exists(tags, lambda t: contains_any(t, needles))

    for needles, label in rules:
        cond = any_tag_has(needles)
        chain = F.when(cond, label) if chain is None else chain.when(cond, label)
    return chain.otherwise(default)
