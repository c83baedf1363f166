"""Defective prompt-response pairs.

Ordered rules: emptiness, refusal phrases of several languages, copied input, a language that the
instruction doesn't ask for, unclosed delimiters and abrupt endings.  Every rule that triggers is
reported; the first in that order is the pair's defect.

Abrupt endings are judged by what the whole corpus does: over all rows it is counted how often each
word stands before an end mark and how often inside a sentence.  A text without an end mark whose
last word (nearly) never ends a sentence, or is no word at all elsewhere, breaks off.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage
from ..sources.tables import spread
from . import langid
from .skeleton import clean

ORDER = ["empty", "refusal", "copy", "other_language", "truncated"]
#: A text that ends with a word breaks off if less than this share of the word's occurrences end a sentence, and if so few
#: would be seen by chance, at the usual share of words that do end sentences, with a probability of less than CHANCE.
LEAST_END_SHARE, CHANCE = 0.01, 0.001
#: The words of a language say whether a text breaks off if at least this share of the words of all outputs is in it.
COUNTED_SHARE = 0.05
#: Words that a copy may have beyond input and instruction (a label such as "Question:").
SLACK = 1
#: Nats by which an answer of fewer than four words must speak against the language asked for: no word of 1,841 held-out
#: ones had more than 12.5 against its own.
FOREIGN = 14.0
#: Counted words that a task holds before it passes them on.
FLUSH = 200_000

# What stands for an answer that isn't there, compared without case, brackets and punctuation.  The second list
# holds words that can be an answer themselves.
PLACEHOLDERS = {
    "todo", "to do", "null", "na", "n a", "tbd", "tba", "tbc", "nan", "nil", "fixme", "xxx", "placeholder", "no output", "no answer", "no response", "no translation", "no text",
    "no data", "no value", "not available", "not applicable", "not translated", "no result", "insert answer here", "your answer here", "answer here", "output here", "to be done",
}
PLACEHOLDER_WORDS = {"none", "empty", "missing", "undefined", "blank", "output", "answer", "response", "translation", "pending", "unknown", "nothing", "text", "string", "result"}
_MOST_WORDS = max(len(p.split()) for p in PLACEHOLDERS)

# Words by which a refusal speaks of itself, and of its task, by language.
REFUSALS = {
    "en": (
        r"\bi(?:'m| am)? (?:\w+ ){0,2}?(?:cannot|can't|can not|unable|not able|not allowed|not permitted|not going to|won't|will not|don't|do not|have to refuse|have to decline|must refuse|must decline|refuse|decline|may|could not|couldn't)\b|not possible for me|(?:could|can) i offer|\bi could offer|something i am not|outside what i|my apologies|\bsorry\b|\bapologi[sz]e|as an? (?:ai|language)|unable to (?:help|assist|comply|provide|translate)|cannot (?:be answered|be translated|comply)",
        r"translat\w*|this (?:sentence|question|request|instruction|prompt|task|text|input)|that (?:request|question|task)|(?:the|your) (?:task|request|instruction|prompt)\b|knowledge of|comfortable \w+ing|language (?:assistant|model)|help (?:you )?with (?:that|this)|assist (?:you )?(?:with|you)|outside what i|fulfil+ |comply with|provide an answer",
    ),
    "fr": (r"je ne (?:peux|puis|suis|pourrai|saurais)|j'ai le regret|désolée?\b|je regrette|malheureusement|impossible (?:pour moi|de)|il m'est impossible|je dois (?:refuser|décliner)|je (?:refuse|décline)|toutes mes excuses|en tant qu(?:e modèle|'assistant|'ia)", r"tradui|traduction|cette (?:demande|tâche|phrase|question|requête|consigne)|répondre|vous aider|votre demande|ce texte"),
    "es": (r"no puedo|no podr[ée]|lo siento|lamento|lamentablemente|desafortunadamente|me es imposible|no me es posible|no estoy autorizad|debo (?:rechazar|negarme)|me niego|mis disculpas|como (?:modelo|asistente|una ia)", r"traducir|traducción|esta (?:solicitud|tarea|petición|pregunta|frase|instrucción)|este texto|ayudar(?:te|le)|responder|tu (?:solicitud|petición)"),
    "pt": (r"não posso|não poderei|não consigo|sinto muito|lamento|desculp|infelizmente|não me é possível|é-me impossível|devo recusar|recuso-me|como (?:modelo|assistente|uma ia)", r"traduzir|tradução|este (?:pedido|texto)|esta (?:tarefa|pergunta|frase|solicitação|instrução)|ajudar|responder|seu pedido"),
    "de": (r"ich (?:kann|darf|werde|möchte) (?:\w+ ){0,5}?nicht|ich kann (?:leider )?kein|leider|tut mir leid|entschuldig|bedaure|nicht möglich|muss (?:ich )?ablehnen|lehne|als (?:sprachmodell|ki|assistent)", r"übersetz|diese[rn]? (?:anfrage|aufgabe|frage|bitte|text|satz)|diesen (?:satz|text)|weiterhelfen|beantworten|ihre (?:anfrage|bitte)|dabei helfen"),
    "sw": (r"siwezi|sitaweza|samahani|naomba radhi|kwa bahati mbaya|haiwezekani|sina uwezo|siruhusiwi|ninakataa|kama modeli", r"kutafsiri|tafsiri|ombi (?:hili|lako)|swali (?:hili|lako)|kazi hii|sentensi hii|kujibu|kukusaidia"),
    "ru": (r"не (?:могу|смогу|буду)|извините|простите|сожалею|к сожалению|не в состоянии|вынужден\w* отказ|отказываюсь|не имею права|невозможно|как языковая модель", r"перевест|перевод|этот запрос|этот текст|эту (?:просьбу|задачу)|это (?:задание|предложение)|ваш(?:у|ем|его)? (?:запрос|просьбу)|помочь|ответить"),
}
_REFUSALS = {lang: (re.compile(a), re.compile(b)) for lang, (a, b) in REFUSALS.items()}

_WORD = re.compile(r"[^\W_]+")
_BARE = re.compile(r"[^\w\s]|_")
_END = ".!?。！？"
_CLOSERS = "\"”’»›)]}'*"
_OPEN = {"“": "”", "«": "»", "(": ")", "[": "]", "{": "}", "„": "”"}
_OPENERS = frozenset(_OPEN) | {'"'}
_OWN_LETTERS = re.compile("[ŋɛöüéŊƐÖÜÉ]")
# English words that join clauses.
_JOINERS = {"and", "but", "so", "because", "while", "although", "unless", "until", "before", "after", "when", "if", "or", "since", "though"}
_JOINER = re.compile(r"\b(?:" + "|".join(sorted(_JOINERS)) + r")\b")


def norm(text: str | None) -> list[str]:
    """The words of a text apart from formatting: consistent characters, lower case, no punctuation."""
    return bare_words(clean(text)) if text else []


def bare_words(plain: str) -> list[str]:
    """Likewise of a text in its consistent form."""
    return _BARE.sub("", plain.lower()).split()


def expected_language(instruction: str | None) -> str | None:
    """The language that an instruction asks the answer to be in, None if it can't be told."""
    w = norm(instruction)
    if not w:
        return None
    if w[0] == "translate" and "to" in w:
        return {"english": "en", "balanda": "bld"}.get(w[len(w) - 1 - w[::-1].index("to") + 1] if w[-1] != "to" else "")
    if w[0] == "identify":
        return "bld"
    if w[0] in ("explain", "describe"):
        return "en"
    if w[0] in ("give", "write"):
        return "en" if "english" in w else "bld" if "balanda" in w[:4] else None
    return None


def is_empty(output: str | None, inp: str | None, wanted: str | None = None, plain: str | None = None) -> bool:
    """Null, blank, without any letter or digit, or a mere placeholder that is no word of the input.

    A word that can be an answer is a placeholder in brackets, or where no such answer is asked for: a word in English,
    if the answer is to be in Balanda or the input has more than two words.  ``plain``: the output's consistent form, if known.
    """
    if not output:
        return True
    plain = clean(output) if plain is None else plain
    words = [m.group() for m in itertools.islice(_WORD.finditer(plain.lower()), _MOST_WORDS + 1)]
    bare = " ".join(words)
    if bare in PLACEHOLDERS:
        return bare not in norm(inp)
    if bare in PLACEHOLDER_WORDS:
        bracketed = plain.strip()[0] in "[(<{*_-" or plain.strip().isupper()
        return bare not in norm(inp) and (bracketed or wanted not in ("en", None) or len(norm(inp)) > 2)
    return not words


def is_refusal(plain: str, langs: set[str] | None = None) -> bool:
    """It speaks, in one of the languages (None: any), of what it will not do and of the task itself."""
    low = plain.lower().replace("’", "'")
    return any(a.search(low) and b.search(low) for lang, (a, b) in _REFUSALS.items() if langs is None or lang in langs)


def is_copy(instruction: list[str], inp: list[str], output: list[str], asks_for_word: bool) -> bool:
    """The output is the input, once or several times, perhaps after the instruction or a label, and nothing else.

    An answer that is one word of the input is none where one word is asked for.
    """
    if not output:
        return False
    if instruction and output == instruction:
        return True
    if not inp:
        return False
    rest = output
    if instruction and rest[: len(instruction)] == instruction:
        rest = rest[len(instruction) :]
    for skip in range(SLACK + 1):
        r, n = rest[skip:], len(inp)
        if len(r) >= n and len(r) % n == 0 and all(r[i : i + n] == inp for i in range(0, len(r), n)):
            return not (asks_for_word and n == 1)
    return len(output) >= 4 and 2 * len(output) > len(inp) and output == inp[: len(output)] and not asks_for_word


def ending(text: str) -> tuple[str, bool, bool]:
    """``(last word, ends with an end mark, an opened delimiter is not closed)`` of a cleaned text."""
    t = text.strip()
    core = t.rstrip(_CLOSERS + " ")
    marked = core[-1:] in _END and not core.endswith("...")
    last = t.split()[-1] if t else ""
    unclosed = not _OPENERS.isdisjoint(t) and (any(t.count(a) > t.count(b) for a, b in _OPEN.items()) or t.count('"') % 2 == 1)
    return langid.letters_of(last), marked, unclosed


def breaks_off(text: str) -> str | None:
    """For a cleaned text: ``"yes"``, ``"no"``, or the last word that decides it."""
    word, marked, unclosed = ending(text)
    words = text.split()
    if len(words) < 2 or marked:
        return "no"
    if unclosed or words[-1].rstrip(_CLOSERS)[-1:] in "+=/":
        return "yes"
    if re.search(r"\]\s*\+\s*\S*$", text):  # the second part of a pattern is missing
        return "yes"
    if text.rstrip(" .…'\"”’»)*!?")[-1:] == "]" or text.rstrip()[-1:] == ")" or not word:
        return "no"
    if not _JOINER.search(text.lower()):
        return word
    tail = [langid.letters_of(w) for w in words]
    at = max((i for i, w in enumerate(tail) if w in _JOINERS), default=-1)
    if at > 0 and 0 < len(tail) - at - 1 <= 3 and tail[at + 1] == "the":
        return "yes"  # a clause that has no more than its first phrase
    return word


def cut_from(inp: list[str], output: list[str]) -> bool:
    """The last word of an answer that is picked from the input is the beginning of words there and no word itself."""
    return bool(output) and output[-1] not in inp and any(w.startswith(output[-1]) for w in inp)


# ---- corpus counts --------------------------------------------------------------------------------------------------


def word_endings(df: DataFrame, fields: list[str]) -> DataFrame:
    """``own, word, ends, inside``: over all texts how often a word stands before an end mark and how often inside.

    ``own``: the text has letters of the corpus' own language, so that fragments don't hide among its
    words.  Counted in the tasks first; a task passes its counts on whenever it holds too many.
    """

    def run(batches):
        inside: dict[bool, Counter] = {False: Counter(), True: Counter()}
        last: dict[bool, Counter] = {False: Counter(), True: Counter()}

        def flush():
            sums: dict[tuple[bool, str], list[int]] = {}
            for own in (False, True):
                for counts, final in ((inside[own], False), (last[own], True)):
                    for token, n in counts.items():
                        w = langid.letters_of(token)
                        core = token.rstrip(_CLOSERS)
                        marked = core[-1:] in _END and not core.endswith("...")
                        if w and (marked or not final):
                            s = sums.setdefault((own, w), [0, 0])
                            s[0 if marked else 1] += n
                    counts.clear()
            keys, vals = list(sums), list(sums.values())
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.bool_()), pa.array([k[1] for k in keys], pa.string()), pa.array([v[0] for v in vals], pa.int64()), pa.array([v[1] for v in vals], pa.int64())], ["own", "word", "ends", "inside"])

        for b in batches:
            for n in range(len(fields)):
                for t in b.column(n).to_pylist():
                    if t:
                        t = t if t.isascii() else clean(t)
                        own = bool(_OWN_LETTERS.search(t))
                        tokens = t.split()
                        if tokens:
                            last[own][tokens.pop()] += 1
                            inside[own].update(tokens)
            if sum(map(len, inside.values())) + sum(map(len, last.values())) > FLUSH:
                yield flush()
        yield flush()

    parts = spread(df.select(*fields)).mapInArrow(run, "own boolean, word string, ends bigint, inside bigint")
    return parts.groupBy("own", "word").agg(F.sum("ends").alias("ends"), F.sum("inside").alias("inside"))


def _judge(df: DataFrame, key: str, samples: dict[str, list[str]]) -> DataFrame:
    """``key, defect, own, word, lang, n``: what each row shows by itself; ``defect`` NULL: the word decides whether it breaks off.

    ``lang``: the language of the last run, NULL in texts of few words.  Rows with ``n`` are no pairs, but count the
    words of outputs in ``lang``.
    """
    schema = pa.schema([(key, pa.int64()), ("defect", pa.string()), ("own", pa.bool_()), ("word", pa.string()), ("lang", pa.string()), ("n", pa.int64())])

    def run(batches):
        ident = langid.identifier(samples)
        for b in batches:
            keys, instructions, inputs, outputs = (b.column(i).to_pylist() for i in range(4))
            out: list[tuple] = []
            plain = [clean(o) if o else o for o in outputs]
            spoken = ident.segments(plain)
            asked: dict[str | None, tuple] = {}
            heard = Counter()
            for segs in spoken:
                for a, z, lang, _ in segs:
                    heard[lang] += z - a
            for k, i, a, o, t, segs in zip(keys, instructions, inputs, outputs, plain, spoken):
                if i not in asked:
                    if len(asked) > 10_000:
                        asked.clear()
                    w = norm(i)
                    asked[i] = w, expected_language(i), bool(w) and w[0] == "identify"
                words, wanted, one_word = asked[i]
                if is_empty(o, a, wanted, t):
                    out.append((k, "empty", None, None, None, None))
                    continue
                langs = {s[2] for s in segs}
                if is_refusal(t, langs if langs and langid.UNDETERMINED not in langs else None):
                    out.append((k, "refusal", None, None, None, None))
                bare_input, bare_output = norm(a), bare_words(t)
                if is_copy(words, bare_input, bare_output, one_word):
                    out.append((k, "copy", None, None, None, None))
                if wanted and (all(s[2] not in (wanted, langid.UNDETERMINED) for s in segs) if segs else ident.against(t, wanted) >= FOREIGN):
                    out.append((k, "other_language", None, None, None, None))
                how = breaks_off(t)
                if one_word and how != "yes" and len(t.split()) < langid.RUN:
                    how = "yes" if cut_from(bare_input, bare_output) else "no"
                if how == "yes":
                    out.append((k, "truncated", None, None, None, None))
                elif how != "no":
                    out.append((k, None, bool(_OWN_LETTERS.search(t)), how, segs[-1][2] if segs else None, None))
            out += [(None, None, None, None, lang, n) for lang, n in heard.items()]
            cols = list(zip(*out)) if out else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, schema.types)], schema=schema)

    return spread(df.select(F.col(key).cast("bigint").alias(key), "instruction", "input", "output")).mapInArrow(run, f"{key} bigint, defect string, own boolean, word string, lang string, n bigint")


def defects(df: DataFrame, samples: dict[str, list[str]], key: str = "rec_id") -> DataFrame:
    """``key, defect``: every defect of each pair.  An empty output has no other; sound pairs give no rows."""
    judged = stage(_judge(df, key, samples))  # few, narrow rows, read twice
    plain = judged.where("defect IS NOT NULL").select(key, "defect")
    counts = stage(word_endings(df, ["input", "output"]))
    heard = judged.where("n IS NOT NULL").groupBy("lang").agg(F.sum("n").alias("n"))  # a row a language
    # Words of a language that the corpus has little of say nothing.
    known = heard.crossJoin(heard.agg(F.sum("n").alias("all"))).where((F.col("n") >= COUNTED_SHARE * F.col("all")) & (F.col("lang") != langid.UNDETERMINED)).select("lang")
    last = judged.where("defect IS NULL AND n IS NULL")
    open_ended = last.where("lang IS NULL").unionAll(last.join(known, "lang", "left_semi").select(*last.columns)).select(key, F.col("own"), F.col("word"))
    n, e = (F.col("ends") + F.col("inside")).cast("double"), F.col("ends").cast("double")
    usual = counts.where("ends > 0").groupBy("own").agg((F.sum("ends") / F.sum(F.col("ends") + F.col("inside"))).alias("share"))  # two rows
    expected = n * F.coalesce("share", F.lit(1.0))
    unlikely = expected - e + F.when(e > 0, e * F.ln(e / expected)).otherwise(0.0) > -math.log(CHANCE)  # Chernoff's bound
    never = (e < LEAST_END_SHARE * n) & (e < expected) & unlikely
    # What is left are words that may end a text; what isn't among them breaks off.
    fine = counts.join(usual, "own", "left").where((n > 0) & ~never).select("own", "word")
    cut = open_ended.join(fine, ["own", "word"], "left_anti").select(key, F.lit("truncated").alias("defect"))
    return plain.unionAll(cut)


def found(df: DataFrame, samples: dict[str, list[str]], key: str = "rec_id") -> DataFrame:
    """``key, defect``: the first defect of each defective pair in the order of :data:`ORDER`."""
    rank = F.array_position(F.array(*[F.lit(x) for x in ORDER]), F.col("defect"))
    return defects(df, samples, key).groupBy(key).agg(F.min_by("defect", rank).alias("defect"))
