"""Who speaks in a line of a dialogue, what is said in it, and how much a paragraph sounds like its narrator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskb.functions.text import strip_text

NARRATOR = "Макс"
# Patterns that results depend on, each whole.
#: The narrator says that they speak.
SELF_SPEAKS = (
    r"\b(?:сказал[аи]?\s+я|спросил[аи]?\s+я|ответил\s+я|вздохнул\s+я|буркнул\s+я|пробормотал\s+я|"
    r"согласился\s+я|подтвердил\s+я|возразил\s+я|воскликнул\s+я|прошептал\s+я|предложил\s+я)\b"
)
#: A verb and the name, with an optional title, of who speaks.
NAME_SPEAKS = (
    r"(?:сказал[аи]?|спросил[аи]?|ответил[аи]?|проворчал[аи]?|пробормотал[аи]?|буркнул[аи]?|вздохнул[аи]?|усмехнулся|усмехнулась|"
    r"рассмеялся|рассмеялась|кивнул[аи]?|покачал[аи]?\s+головой|объяснил[аи]?|заметил[аи]?|добавил[аи]?|согласился|согласилась|"
    r"обиделся|обиделась|подтвердил[аи]?|возразил[аи]?|воскликнул[аи]?|прошептал[аи]?|предложил[аи]?|попросил[аи]?|крикнул[аи]?|"
    r"произнёс|произнесла)\s+((?:сэр\s+|леди\s+|господин\s+)?[А-ЯЁ][а-яё]+(?:\s+[А-ЯЁ][а-яё\-]+)?)"
)
#: A verb and a pronoun.
PRONOUN_SPEAKS = r"(?:сказал[аи]?|спросил[аи]?|ответил[аи]?)\s+(я|он|она)\b"
#: The beginning of an author's insert.
INSERT_BEGINS = (
    r"^(?:сказал|спросил|ответил|вздохнул|проворчал|буркнул|пробормотал|усмехнул|рассмеял|кивнул|покачал|объяснил|заметил|добавил|"
    r"согласил|обидел|подтвердил|возразил|воскликнул|прошептал|предложил|попросил|крикнул|произнёс|произнесла)"
)
#: Marks of the narrator's inner voice, and words of the first person.
VOICE_MARKS = (
    r"\bя\s+(подумал|решил|вздохнул|усмехнул|обрадовал|ужаснул|растерял|понял|вспомнил|представил|почувствовал)\b",
    r"\bмне\s+(казалось|хотелось|пришлось|стало|показалось|нравилось|было\s+страшно|было\s+стыдно|было\s+лень)\b",
    r"\bмоя\s+(жизнь|судьба|голова)\b", r"\bк\s+счастью\b", r"\bк\s+сожалению\b", r"\bвпрочем\b", r"\bстрого\s+говоря\b", r"\bна\s+самом\s+деле\b", r"\bчестно\s+говоря\b", r"\bнадо\s+же\b",
    r"\bбоже\s+мой\b", r"\bгрёбаные\s+магистры\b", r"\bхвала\s+магистрам\b", r"\bдырку\b.*\bв\s+небе\b", r"\bкамр[уыа]\b",
)
FIRST_PERSON = r"\b(я|мне|мой|моя|моё|мою|моей|моих|меня|мной)\b"

#: Silent speech, the narrator as its speaker, and the speakers known by name.
SILENT = (
    r"[Бб]езмолвн|[Зз]ов\b|послал[аи]?\s+зов|мысленно|подумал[аи]?\s+я|сказал[аи]?\s+я\s+(?:ему|ей|им)\s+мысленно|"
    r"ответил[аи]?\s+я\s+мысленно|услышал\s+я\s+(?:его|её|их)\s+голос|прозвучал\s+(?:в|у)\s+(?:моей|моём)\s+голов"
)
SILENT_SELF = r"подумал\s+я|сказал\s+я|ответил\s+я|послал\s+я|мой\s+зов|я\s+послал"
KNOWN_SPEAKERS = (
    "Джуффин", "Шурф", "Мелифаро", "Кофа", "Меламори", "Теххи", "Нумминорих", "Лонли-Локли", "Халли", "Гуриг", "Нуфлин", "Сотофа", "Лойсо", "Дримарондо", "Друппи", "Франк", "Кекки", "Базилио", "Кима", "Анчифа", "Мохи",
    "Джуффин Халли", "Шурф Лонли-Локли", "Кофа Йох", "Меламори Блимм",
)


def speaker(line: Column, after: Column) -> Column:
    """The speaker that a line and what follows it name: the narrator, a name after a verb, a pronoun; null if none."""
    said = F.concat_ws(" ", line, F.coalesce(after, F.lit("")))
    own = said.rlike("(?U)" + SELF_SPEAKS)
    name = F.nullif(strip_text(F.regexp_extract(said, "(?U)" + NAME_SPEAKS, 1)), F.lit(""))
    pronoun = F.nullif(F.regexp_extract(said, "(?U)" + PRONOUN_SPEAKS, 1), F.lit(""))
    return F.when(own, NARRATOR).otherwise(F.coalesce(name, F.when(pronoun == "я", NARRATOR).otherwise(pronoun)))


def said(line: Column) -> Column:
    """What is said in a line: an author's insert is dropped up to the sentence after it; no closing dots."""
    parts = F.split(line, r"(?U)\s*—\s*(?=[а-яё])")
    insert = lambda p: p.rlike("(?iU)" + INSERT_BEGINS)
    rest = lambda p: F.nullif(F.regexp_extract(p, r"(?U)[.!?]\s*—?\s*([^\n]+)", 1), F.lit(""))
    kept = F.filter(F.transform(parts, lambda p, i: F.when((i > 0) & insert(p), rest(p)).otherwise(p)), lambda p: p.isNotNull())
    return F.regexp_replace(strip_text(F.regexp_replace(F.array_join(kept, " "), r"(?U)\s+", " ")), r"\.+\z", "")


def voice_marks(paragraph: Column) -> Column:
    """How many of the marks of an inner voice a paragraph has, each counted once."""
    return sum((F.coalesce(paragraph.rlike("(?iU)" + m).cast("int"), F.lit(0)) for m in VOICE_MARKS), F.lit(0))


def first_person(paragraph: Column) -> Column:
    return F.size(F.regexp_extract_all(paragraph, F.lit("(?iU)" + FIRST_PERSON), F.lit(0)))


def is_silent(around: Column) -> Column:
    return around.rlike("(?U)" + SILENT)


def silent_speaker(around: Column) -> Column:
    """The narrator if they say so, else the first of the known speakers whose name stands there, else null."""
    known = F.coalesce(*(F.when(F.contains(around, F.lit(name)), name) for name in KNOWN_SPEAKERS))
    return F.when(around.rlike("(?U)" + SILENT_SELF), NARRATOR).otherwise(known)
