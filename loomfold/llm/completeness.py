"""Is a text whole, or was its end lost? A stack automaton over its structure and a look at how it ends."""

from __future__ import annotations

import json
import re

#: Marks that are put behind a text that was cut (fixed values).
CUT_MARK = re.compile(r"(?:\[\W*(?:content |output |text |dom )?(?:truncated|clipped|cut off|snipped?)\W*\]|<\W*(?:truncated|clipped|snip(?:ped)?|cut)\W*>|\((?:truncated|clipped)\))\s*$", re.I)
#: What ends a sentence, a quotation, a group or a code span, in the scripts of the texts (fixed values).
TERMINATORS = set(".!?。！？．…:;\"”»'’)]}）」』】>`|")
OPENING = {"(": ")", "[": "]", "{": "}", "（": "）", "「": "」", "『": "』", "【": "】", "“": "”", "«": "»"}
CLOSING = {b: a for a, b in OPENING.items()}
#: Words of a phrase that needs no full stop, and words that never end one: articles, prepositions, conjunctions (fixed values).
PHRASE = 4
NEVER_LAST = set("""
    the a an of to in at by for from with and or but than as is are was were be its their your my
    der die das dem den des ein eine einen einem einer und oder aber von zu zum zur im am mit für bei aus nach als ist sind war
    le la les un une des du de et ou mais que qui à au aux dans par pour avec sur est sont
    el los las una unos unas del y o pero al en con por para sin es son
""".split())
VOID_TAGS = {"br", "hr", "img", "input", "meta", "link", "area", "base", "col", "embed", "source", "track", "wbr"}

#: An opening or closing tag that the text breaks off in: a name, whole attributes, perhaps a part of the last one.
_BROKEN_TAG = r"""<[A-Za-z/][\w-]*(?:\s+[\w:-]+(?:=(?:"[^"<>]*"?|'[^'<>]*'?|[^\s"'<>]*))?)*\s*/?\Z"""
_TOKEN = re.compile(r"```|`|<(/?)([A-Za-z][\w-]*)([^<>]*?)(/?)>|" + _BROKEN_TAG + r"|[(){}\[\]（）「」『』【】“”«»\"]")
_JSON_START = re.compile(r'\s*(?:\{\s*["}]|\[\s*[\[{"\]\d-])')
_FENCE = re.compile(r"(?m)^\s*```")
_URL = re.compile(r"(?:https?|ftp)://\S+\.\S+/\S*\Z|(?:https?|ftp)://[\w.-]+\.\w{2,}/?\Z")
_TAG = re.compile(r"(?:^|\s)(?:#|-- )[A-Za-z]{1,6}-\d+(?=\s|\Z)")
_DOTS = re.compile(r"[^\W_](?:\.\.\.|…)\Z")
_ITEM = re.compile(r"\s*(?:[-*•+]|\d+[.)])\s+\S")
_HIDDEN = re.compile(r"<(think|thinking|reasoning)>", re.I)
_HIDDEN_END = re.compile(r"</(think|thinking|reasoning)>", re.I)


def open_structures(text: str) -> list[str]:
    """What is still open at the end of a text: code fences and spans, tags and brackets, in the order of their opening.

    A tag or bracket that closes something further out closes what lies within, as readers of markup do. Inside code
    only the end of the code counts. Lone quotation marks (inches, apostrophes) count within the last paragraph only.
    """
    stack: list[str] = []
    tagged = False
    fence_lines = {m.end() - 3 for m in _FENCE.finditer(text)}
    last_paragraph = text.rfind("\n\n") + 1
    for m in _TOKEN.finditer(text):
        token = m.group()
        if token == "```":
            if stack and stack[-1] == "```":
                stack.pop()
            elif m.start() in fence_lines or "```" not in stack:
                stack.append("```")
            continue
        if stack and stack[-1] == "```":
            continue
        if token == "`":
            if stack and stack[-1] == "`":
                stack.pop()
            elif m.start() >= last_paragraph or "\n" not in text[m.start() :]:
                stack.append("`")
            continue
        if stack and stack[-1] == "`":
            continue
        if token[0] == "<" and m.group(2):
            name, tagged = m.group(2).lower(), True
            if m.group(1):
                if f"<{name}" in stack:
                    del stack[len(stack) - 1 - stack[::-1].index(f"<{name}") :]
            elif not m.group(4) and name not in VOID_TAGS:
                stack.append(f"<{name}")
        elif token[0] == "<":
            if tagged:  # else it may be a comparison
                stack.append("<")
        elif token == '"':
            if '"' in stack:
                del stack[len(stack) - 1 - stack[::-1].index('"') :]
            elif m.start() >= last_paragraph:
                stack.append('"')
        elif token in OPENING:
            stack.append(token)
        elif (start := CLOSING[token]) in stack:
            del stack[len(stack) - 1 - stack[::-1].index(start) :]
    return stack


def open_json(text: str) -> bool:
    """Text that starts like a JSON object or array of JSON but isn't closed."""
    if not _JSON_START.match(text):
        return False
    try:
        json.loads(text)
        return False
    except ValueError:
        depth, quoted, escaped = 0, False, False
        for c in text:
            if quoted:
                if escaped:
                    escaped = False
                elif c == "\\":
                    escaped = True
                elif c == '"':
                    quoted = False
            elif c == '"':
                quoted = True
            elif c in "{[":
                depth += 1
            elif c in "}]":
                depth -= 1
        return depth > 0 or quoted


def cut_reason(text: str | None, answer: bool = True, log: bool = False) -> str | None:
    """Why a text counts as cut off, or None where it is whole.

    marker: a mark of the cut is left; bytes: it ends in a broken multibyte sequence; escape: in a broken escape;
    json, code, markup, bracket, quote: a structure is left open; ending: running text ends without what ends a
    sentence. answer: short answers without a full stop are whole. log: lines of output need no full stop.
    """
    if not text or not (body := text.rstrip()):
        return None
    if CUT_MARK.search(body):
        return "marker"
    if "\ufffd" in body[-2:] or (body and 0xD800 <= ord(body[-1]) <= 0xDFFF):
        return "bytes"
    if re.search(r"\\(?:u[0-9a-fA-F]{0,3}|x[0-9a-fA-F]?)?\Z", body):
        return "escape"
    if open_json(body):
        return "json"
    if body[0] in "{[" and body[-1] in "}]":
        return None
    stack = open_structures(body)
    if "```" in stack or "`" in stack:
        return "code"
    tags = [s for s in stack if s[0] == "<" and s not in ("<p", "<li", "<td", "<tr", "<th", "<dt", "<dd") or s[0] == "<" and body.count("</" + s[1:]) > 0]
    if tags:
        return "hidden" if _HIDDEN.search(tags[-1] + ">") else "markup"
    if any(s[0] == "<" for s in stack):
        return "markup"
    if any(s in OPENING for s in stack) and _open_at_end(body, stack):
        return "bracket"
    if '"' in stack and body[-1] not in TERMINATORS:
        return "quote"
    if _DOTS.search(body):
        return "ending"
    if body[-1] in TERMINATORS or log or body[-1] == "," and body[-2:-1] in (".", "!", "?"):
        return None
    return None if _whole_without_stop(body, answer) else "ending"


def last_piece(text: str | None) -> str | None:
    """What decides whether a text without a full stop is whole: the last word of its list, or the form of its tag.

    Whole lists and tags also stand inside texts, where nothing is lost: pieces that never occur there are cut.
    """
    if not text or not (body := text.rstrip()) or body[-1] in TERMINATORS:
        return None
    line = body.rsplit("\n", 1)[-1]
    if (tag := _TAG.search(line)) and tag.end() == len(line):
        return form(tag.group())
    return "w " + line.split()[-1].lower() if _ITEM.match(line) else None


def inner_pieces(text: str) -> list[str]:
    """The pieces inside a text that are whole for sure: ends of list items and tags with more text behind."""
    body = text.rstrip()
    end = body.rfind("\n") if "\n" in body else -1
    pieces = ["w " + x.split()[-1].lower() for x in body[:end].split("\n") if _ITEM.match(x)] if end > 0 else []
    return pieces + [form(m.group()) for m in _TAG.finditer(body) if m.end() < len(body)]


def form(tag: str) -> str:
    """A tag with its letters and digits made alike."""
    return "t " + re.sub(r"\d", "0", re.sub(r"[^\W\d_]", "a", tag.strip()))


def _open_at_end(body: str, stack: list[str]) -> bool:
    """An open bracket tells a cut only if no sentence ends behind it."""
    last = max(body.rfind(s) for s in stack if s in OPENING)
    return not re.search(r"[.!?。！？][\"”)\]]?(?:\s|\Z)", body[last:])


def _whole_without_stop(body: str, answer: bool) -> bool:
    line = body.rsplit("\n", 1)[-1]
    last = body.split()[-1] if body.split() else body
    if _URL.search(last) or (tag := _TAG.search(line)) and tag.end() == len(line):
        return True
    if _ITEM.match(line):
        # a list: items without a full stop, closed by a whole item
        lines = [x for x in body.split("\n") if _ITEM.match(x)]
        shape = lambda x: len(re.findall(r"[^\W\d_]+|\d+", x))
        return len(lines) == 1 or shape(line) >= shape(lines[-2]) - 1
    if answer:  # a number, a name, a phrase: no sentence before it, and no last word that calls for another
        return len(body.split()) <= PHRASE and not re.search(r"[.!?。]\s", body) and last.lower() not in NEVER_LAST
    return False
