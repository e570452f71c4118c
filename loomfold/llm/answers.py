"""Broken prompt and response pairs: empty, cut off, refused, copied and other-language answers.

Each user message and the last assistant message before the next one is a pair. Its defect is the first that holds:

empty      no tool call and nothing a reader would see: white space, zero-width characters, hidden reasoning only;
copy       the question again: the answer is compressed with its prompt as zstandard dictionary; one that all but
           vanishes is checked word by word;
truncated  the structural check of ``completeness`` (a terminal-context model of how whole texts end) finds a cut;
refusal    a phrase of the refusal dictionary, and no more than a closing phrase besides;
language   the language dictionaries are sure of both languages, they differ, and the question doesn't name the
           language of the answer.

One narrow pass; a record is the unit of work. The pieces that need the dictionary of whole list ends
(``truncation``) are joined to it, not broadcast.

Defined results. Messages that cannot be decoded have no pairs; a user message without an assistant message behind it
is no pair; null content counts as empty text; a null key leaves the row out; repeated rows have their own pairs.
Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomfold.functions.decode import content_text, inner, items, messages_of, rows_of
from loomfold.llm.completeness import cut_reason, inner_pieces, last_piece
from loomfold.llm.truncation import known_pieces
from loomfold.session import ship, spread, written

#: Frequent function words of the languages (fixed values).
FUNCTION_WORDS = {
    "en": "the a an and or of to in is are was were be been it that this with for on at by from as not but if so i you we they he she my your our what which who how why when where do does did has have had can could would should will there please me tell than then only any some no its into".split(),
    "de": "der die das den dem des ein eine einen einem einer und oder ist sind war wird werden wurde nicht mit für von zu zum zur im in auf an aus bei nach über ich du er sie es wir ihr mein mich mir ihm ihn noch auch aber wenn weil dass daß wie was wer warum wo viele bis seit etwa danach damit kann sich als so diese dieser dieses bitte".split(),
    "fr": "le la les un une des du de et ou est sont était être à au aux en dans sur pour par avec sans que qui quoi dont ne pas plus ce cette ces il elle on nous vous je tu mon ma mes son sa ses leur depuis pourquoi merci combien peux quel quelle jusqu environ puis si se été moi".split(),
    "es": "el la los las un una unos unas de del y o es son era ser a al en con por para sin que quien cual no más este esta estos estas ese esa lo se su sus mi mis me tu te yo él ella hay fue ha he ya muy cuando cómo cuánto cuánta cuántas cuántos desde hasta unos qué dime primero después".split(),
}
#: Names of the languages, in the languages (fixed values).
LANGUAGE_NAMES = {
    "en": "english englisch englische englischen anglais anglaise inglés inglesa ingles 英語".split(),
    "de": "german deutsch deutsche deutschen allemand allemande alemán alemana aleman ドイツ語".split(),
    "fr": "french französisch französische französischen français française francés francesa frances フランス語".split(),
    "es": "spanish spanisch spanische spanischen espagnol espagnole español española castellano スペイン語".split(),
    "ja": "japanese japanisch japanische japanischen japonais japonaise japonés japonesa 日本語".split(),
}
#: What declines a task (fixed values, as patterns).
REFUSALS = re.compile("|".join((
    r"\bi(?:'m|’m| am)? (?:really |very |truly )?(?:sorry|afraid)\b[^.!?]*\b(?:can(?:'|’)?t|cannot|can not|unable|won(?:'|’)t|not able)\b[^.!?]*\b(?:help|assist|do that|answer|provide|comply|fulfil)",
    r"\bi (?:cannot|can(?:'|’)t|can not|could not|won(?:'|’)t|will not) (?:be able to )?(?:assist|help|carry this out|answer|comply|provide|fulfil|take this on|do this for you|do that for you|discuss)",
    r"\bi(?:'m|’m| am) (?:unable|not able|not permitted|not allowed|not in a position) to (?:take|help|assist|answer|handle|do|provide|carry|comply|discuss|fulfil)",
    r"\bi (?:must|have to|need to|am going to have to) (?:respectfully |politely |regretfully )?(?:decline|refuse|pass\b|turn (?:this|it|that)? ?down)",
    r"\b(?:a |this )?request i must (?:turn down|decline|refuse)", r"\bi(?:'d|’d| would) rather not (?:work on|answer|do|discuss|help)",
    r"\boff the table for me\b", r"\bfalls outside what i (?:may|can|am allowed to)", r"\b(?:lies|is|falls) (?:beyond|outside) my (?:remit|scope|powers|permissions)",
    r"\bnot something i (?:can|may|am able to|am allowed to) (?:do|help|answer|assist)", r"\bno help is available from my side", r"\bmy guidelines leave no room",
    r"\bkann ich (?:ihnen |dir |euch )?(?:leider )?(?:dabei |hierbei |damit )?nicht (?:weiter)?(?:helfen|beantworten|behilflich|dienen)", r"\b(?:muss|müssen) (?:ich|wir) (?:leider )?(?:ablehnen|zurückweisen|absagen)",
    r"\bdarf ich (?:leider )?(?:keine|nicht)\b[^.!?]*\b(?:auskunft|antwort|antworten|helfen|sagen)", r"\b(?:lehne ich|ich lehne)\b[^.!?]*\bab\b", r"\baußerhalb dessen, was ich\b", r"\bbin ich (?:leider )?nicht (?:befugt|berechtigt|in der lage)",
    r"\bje ne (?:peux|puis|pourrai|saurais)(?: malheureusement)? pas (?:vous |t')?(?:aider|répondre|assister|traiter|donner suite)", r"\bje (?:dois|suis obligée? de|préfère) (?:malheureusement )?(?:décliner|refuser)", r"\bsort du cadre de ce que je\b", r"\bje ne suis pas (?:autorisée?|en mesure|habilitée?)", r"\bdépasse ce que je (?:peux|dois)",
    r"\bno (?:puedo|podré|me es posible)(?: lamentablemente)? (?:ayudar|asistir|responder|atender|hacer eso)", r"\b(?:debo|tengo que|me veo obligad[oa] a) (?:rechazar|declinar|negarme)", r"\bfuera de lo que puedo\b", r"\bno estoy (?:autorizad[oa]|en condiciones)",
    r"(?:お手伝い|お答え|お受け|ご案内|対応|回答|ご協力)(?:は|を|が)?(?:いた|致)?(?:し)?(?:かね|できません|出来ません|できかね)", r"お断り(?:し|いた|させて)", r"いたしかねます",
)), re.I)

#: One of these stands in every phrase of the dictionary (fixed values); looked up before the patterns.
TRIGGERS = (
    "assist", "help", "answer", "comply", "provide", "fulfil", "carry", "take", "discuss", "handle", "declin", "refus", "pass", "turn", "rather not", "off the table", "falls", "remit", "scope", "powers",
    "permi", "not something", "guidelines", "nicht", "ablehn", "zurückweis", "absag", "darf", "lehne", "außerhalb", "ne p", "ne s", "déclin", "cadre", "dépasse", "puedo", "podré", "posible", "rechaz", "negarme", "estoy",
    "ません", "かね", "お断り",
)

#: Bytes left of an answer compressed with its prompt, of those without, up to which it may be a copy; words of an edited
#: copy, of those of the question, that may be other ones.
COPY_SHARE, EDITED = 0.35, 0.1
#: Scripts that tell a language, or a family of languages, by themselves (fixed values).
SCRIPTS = {
    "cyrillic": (0x400, 0x52F), "greek": (0x370, 0x3FF), "hebrew": (0x590, 0x5FF), "arabic": (0x600, 0x6FF), "devanagari": (0x900, 0x97F),
    "bengali": (0x980, 0x9FF), "thai": (0xE00, 0xE7F), "georgian": (0x10A0, 0x10FF), "hangul": (0xAC00, 0xD7AF), "han": (0x4E00, 0x9FFF),
}

_HIDDEN = re.compile(r"<(think|thinking|reasoning)>.*?(?:</\1>|\Z)", re.I | re.S)
_UNSEEN = re.compile(r"[\s­͏؜ᅟᅠ឴឵᠎​-‏‪-‮⁠-⁤⁪-⁯ㅤ︀-️﻿ﾠ]+")
_WORDS = re.compile(r"[^\W_]+")
_PLAIN = re.compile(r"[^\W\d_]+")
_CODE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]*`|<[^<>\n]*>|https?://[!-~]+|[!-~]*[/_@\\][!-~]*|[A-Za-z0-9_]+\(\)", re.S)
_KANA = re.compile(r"[぀-ヿ]")
_SENTENCE = re.compile(r"[^.!?。！？]+[.!?。！？]*")
_LANGS = tuple(FUNCTION_WORDS)
_ALL = Counter(w for words in FUNCTION_WORDS.values() for w in set(words))
#: Words of one language only.
_OF = {w: lang for lang, words in FUNCTION_WORDS.items() for w in words if _ALL[w] == 1}
_NAMES = {name: lang for lang, names in LANGUAGE_NAMES.items() for name in names}


def visible(text: str | None) -> str:
    """What a reader sees of an answer: without hidden reasoning, null as empty text."""
    return _HIDDEN.sub("", text or "")


def _script(words: list[str]) -> str | None:
    """The script that most letters of a text are of, where that alone tells the language."""
    text = "".join(words)
    if text.isascii() or len(text) < 8:
        return None
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return next((name for name, (low, high) in SCRIPTS.items() if 2 * np.count_nonzero((codes >= low) & (codes <= high)) > len(codes)), None)


def language(text: str) -> str | None:
    """The language of a text, or None where the dictionaries aren't sure."""
    plain = _CODE.sub(" ", text)
    words = _PLAIN.findall(plain.lower())
    kana = len(_KANA.findall(plain))
    if kana >= 4 and kana >= 2 * sum(w < "ʰ" for w in words):
        return "ja"
    if (script := _script(words)) is not None:
        return script
    scores = Counter(map(_OF.get, words))
    scores.pop(None, None)
    (lang, best), (_, second) = [*scores.most_common(2), (None, 0), (None, 0)][:2]
    return lang if best >= 2 * second and (second == 0 or best * 12 >= len(words)) and (best >= 2 or len(words) <= 4) else None


def named_languages(text: str) -> set[str]:
    """The languages that a text names."""
    low = text.lower()
    found = {_NAMES[w] for w in _PLAIN.findall(low) if w in _NAMES}
    return found | {lang for name, lang in _NAMES.items() if name[-1] == "語" and name in low}


def is_copy(question: str, answer: str) -> bool:
    """Whether an answer says the question again and nothing else."""
    q, a = " ".join(question.lower().split()).encode("utf-8", "replace"), " ".join(answer.lower().split()).encode("utf-8", "replace")
    if not q or not a:
        return False
    if len(q) >= 8:
        known = zstandard.ZstdCompressionDict(q, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        packed = len(zstandard.ZstdCompressor(level=1, dict_data=known, write_content_size=False).compress(a))
        if packed - 12 > COPY_SHARE * len(a):
            return False
    wq, wa = _WORDS.findall(question.lower()), _WORDS.findall(answer.lower())
    if not wq or not wa:
        return False
    times, over = divmod(len(wa), len(wq))
    if times and not over and wa == wq * times:
        return True
    # nearly all of the question in a row
    if len(wa) < len(wq) and len(wa) >= 0.8 * len(wq) and any(wq[i : i + len(wa)] == wa for i in range(len(wq) - len(wa) + 1)):
        return True
    # the question with few words changed, put in or left out, all else in its order
    changes = EDITED * len(wq)
    return changes >= 1 and abs(len(wa) - len(wq)) <= changes and _edits(wq, wa, int(changes)) <= changes


def _edits(a: list[str], b: list[str], most: int) -> int:
    """Words to change, put in or leave out between two texts; more than ``most`` are told as one more. In a band of the table."""
    row = {j: j for j in range(min(len(b), most) + 1)}
    far = most + 1
    for i, x in enumerate(a, 1):
        now = {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            now[j] = i if j == 0 else min(row.get(j - 1, far) + (x != b[j - 1]), row.get(j, far) + 1, now.get(j - 1, far) + 1)
        row = now
        if min(row.values()) > most:
            return far
    return row.get(len(b), far)


def is_refusal(answer: str) -> bool:
    """Whether an answer declines and does nothing besides, however long it is."""
    low = answer.lower()
    if not any(t in low for t in TRIGGERS) or not REFUSALS.search(answer):
        return False
    rest = [s for s in _SENTENCE.findall(answer) if not REFUSALS.search(s)]
    return not re.search(r"(?i)\b(?:but|aber|mais|pero)\b[^.]*\b(?:allows? it|the rest is done)", answer) and not _does_more(rest)


#: Phrases that close a refusal (fixed values, as patterns).
CLOSINGS = re.compile(r"thank you|understanding|anything else|feel free|please (?:ask|contact|turn to)|another topic|let me know|sorry|apolog|regret|verständnis|wenden sie|danke|entschuldig|leid|merci|désolé|n'hésitez|gracias|lo siento|consulte|申し訳|ありがとう|ご了承|ください", re.I)


def _does_more(rest: list[str]) -> bool:
    return any(len(_WORDS.findall(s)) > 2 and not CLOSINGS.search(s) for s in rest)


def defect(question: str, answer: str | None, n_calls: int, earlier: list[str] | tuple = ()) -> str | None:
    """The defect of a pair, or None. earlier: the questions before, which tell the language of one without words (a page)."""
    seen = visible(answer)
    if not _UNSEEN.sub("", seen):
        return None if n_calls else "empty"
    if is_copy(question, seen):
        return "copy"
    if cut_reason(answer):
        return "truncated"
    if is_refusal(seen):
        return "refusal"
    spoken = language(seen)
    if spoken:
        asked = language(question) or next(filter(None, map(language, reversed(earlier))), None)
        same = asked == spoken or {asked, spoken} == {"ja", "han"}  # a Japanese text may do without kana
        if asked and not same and spoken not in named_languages(question):
            return "language"
    return None


def pairs_of(messages: list) -> Iterator[tuple[int, str, str | None, int]]:
    """(number of the user message, question, answer, tool calls of the answer) of a conversation."""
    rows = [m if isinstance(m := inner(x), dict) else {} for x in messages]
    for i, m in enumerate(rows):
        if m.get("role") != "user":
            continue
        answer = None
        for later in rows[i + 1 :]:
            if later.get("role") == "user":
                break
            if later.get("role") == "assistant":
                answer = later
        if answer is not None:
            calls = sum(x is not None for x in items(answer.get("tool_calls")))
            yield i, content_text(m.get("content")) or "", content_text(answer.get("content")), calls


def defective_pairs(records: DataFrame, key: str = "rec_no") -> DataFrame:
    """(key, msg_no, defect): the pairs with a defect; msg_no is the place of the user message."""
    ship(records.sparkSession)
    schema = pa.schema([("key", pa.int64()), ("msg_no", pa.int64()), ("defect", pa.string()), ("piece", pa.string()), ("n", pa.int64())])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, pieces = [], Counter()
            for no, text in rows_of([batch]):
                messages = messages_of(text)
                earlier: list[str] = []
                for i, question, answer, calls in pairs_of(messages or []):
                    found = defect(question, answer, calls, earlier)
                    earlier.append(question)
                    if answer:
                        pieces.update(inner_pieces(answer))
                    if found or (piece := last_piece(answer)):
                        rows.append((no, i, found, None if found else piece, None))
            rows += [(None, None, None, p, n) for p, n in pieces.items()]
            columns = list(zip(*rows)) or [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    rows = spread(records.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint"), "messages"))
    found = written(rows.mapInArrow(check, "key bigint, msg_no bigint, defect string, piece string, n bigint"), "pairs")
    cut = found.where("defect IS NULL AND n IS NULL").join(known_pieces(found), "piece", "left_anti").withColumn("defect", F.lit("truncated"))
    return found.where("defect IS NOT NULL").unionByName(cut).select("key", "msg_no", "defect")
