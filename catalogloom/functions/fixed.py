"""Fixed values.

Word lists, phrases, limits and patterns that results depend on. They are data:
operators take them as defaults and accept replacements. Patterns use Java
syntax; ``(?iU)`` makes case folding, ``\\b`` and ``\\s`` work for Cyrillic.
"""

# Labels that are captions, not names.
STOP_LABELS = [
    "автор", "авторы", "диктор", "чтец", "исполнитель", "жанр", "цикл",
    "следующая", "предыдущая", "аудиокнига",
]
LABEL_MAX_LENGTH = 160
TITLE_LINK_MAX_LENGTH = 300
GENERIC_TITLE_LINKS = ["аудиокнига", "слушать аудиокнигу"]

# Link kinds by href fragment, with the number of names kept.
CARD_LINK_RULES = [
    ("author", "/author/", 5),
    ("narrator", "/voice/", 8),
    ("narrator", "/reader/", 8),
    ("genre", "/genre/", 5),
    ("series", "/cycle/", 1),
    ("series", "/series/", 1),
]
# Link kinds by path prefix (optionally below /index.php).
PREFIX_LINK_RULES = [
    ("author", "/authors/"),
    ("narrator", "/readers/"),
    ("genre", "/genres/"),
    ("series", "/series/"),
]

# Phrases that say an item was taken down.
REMOVED_PHRASES = [
    "аудиокнига удалена по требованию правообладателя",
    "аудиокнига удалена по требованию правообладателей",
    "аудиозапись удалена по требованию правообладателя",
    "аудиозапись удалена по требованию правообладателей",
    "контент удален по требованию правообладателя",
    "контент удалён по требованию правообладателя",
]
REMOVED_TERMS = [
    ["правообладател"],
    ["аудиокнига", "аудиозапись"],
    ["удален", "удалён", "недоступ"],
]
BLOCKED_PHRASES = ["прослушивание заблокировано правообладателем"]
PREVIEW_PHRASES = ["ознакомительный фрагмент", "фрагмент аудиокниги"]
TEASER_TITLES = ["начало", "фрагмент", "ознакомительный фрагмент", "демо", "пробный фрагмент"]
PURCHASE_PHRASES = ["слушать полностью", "купить"]
TRIAL_PATH = "/audiotrial"

# Section markers and limits.
SECTION_START = "описание книги"
SECTION_END = "подробная информация"
DESCRIPTION_LIMIT = 10_000
WHOLE_TEXT_LIMIT = 5_000
MESSAGE_LIMIT = 500
SERIES_NAME_LIMIT = 240
ENTRY_TITLE_LIMIT = 240

# Parts of an address that mark a decorative image.
DECORATIVE_IMAGE_TOKENS = [
    "/smiles/", "/images/smiles/", "emoji", "emoticon", "spacer", "pixel.gif",
    "blank.gif", "transparent", "banner", "badge", "button", "rank", "rating",
    "logo", "avatar", "icon_", "/icons/",
]

# File suffixes of supported media.
AUDIO_SUFFIXES = ["mp3", "m4a", "m4b", "aac", "ogg", "opus", "flac", "wav", "wma"]

# Clocks and the words for hours, minutes and seconds.
CLOCK = r"(?<!\d)\d{1,3}:\d{2}:\d{2}(?!\d)"
MINUTES = r"(?<!\d)\d{1,3}:\d{2}(?!\d)"
CLOCK_TAIL = r"((?:\d+:)?\d{1,2}:\d{2})$"
SHORT_DURATION_WORDS = (r"(?U)(\d+)\s*(?:ч|час)", r"(?U)(\d+)\s*(?:мин|м)\b", r"(?U)(\d+)\s*(?:сек|с)\b")
FULL_DURATION_WORDS = (r"(?U)(\d+)\s*(?:час|часа|часов|ч\.)",
                       r"(?U)(\d+)\s*(?:минута|минуты|минут|мин\.)",
                       r"(?U)(\d+)\s*(?:секунда|секунды|секунд|сек\.)")
DURATION_WORD = r"(?U)\b(?:час|часа|часов|минута|минуты|минут|секунда|секунды|секунд)\b"
FIELD_DURATION_WORDS = (r"(?iU)(?<!\d)(\d{1,3})\s*(?:ч(?:ас(?:а|ов)?)?\.?)"
                        r"(?:\s*(\d{1,2})\s*(?:м(?:ин(?:ут(?:а|ы)?)?)?\.?))?"
                        r"(?:\s*(\d{1,2})\s*(?:с(?:ек(?:унд(?:а|ы)?)?)?\.?))?")

# Size units as powers of 1024.
SIZE_UNITS = {
    "b": 0, "байт": 0,
    "kb": 1, "kib": 1, "кб": 1,
    "mb": 2, "mib": 2, "мб": 2,
    "gb": 3, "gib": 3, "гб": 3,
    "tb": 4, "tib": 4, "тб": 4,
}

# Field labels by meaning, in order of preference.
FIELD_LABELS = {
    "author": ["Автор", "Авторы", "Aвтор", "Aвторы", "Автор (никнейм)", "Фамилия Имя автора",
               "ФИО автора", "Фамилия и имя автора", "Фамилии авторов"],
    "surname": ["Фамилия автора", "Фамилии автора"],
    "given": ["Имя автора", "Имена автора"],
    "narrator": ["Исполнитель", "Исполнители", "Читает", "Текст читает", "Чтец"],
    "genre": ["Жанр", "Жанры"],
    "series": ["Цикл/серия", "Цикл", "Серия"],
    "position": ["Номер книги", "Номер в серии", "№ книги"],
    "title": ["Название", "Наименование", "Название книги", "Название произведения"],
    "duration": ["Время звучания", "Общее время звучания", "Общее звучание", "Продолжительность"],
    "description": ["Описание"],
    "extra": ["Доп. информация", "Дополнительная информация"],
}

# Labels that end the value before them.
KNOWN_LABELS = [
    "год выпуска", "год издания", "автор", "авторы", "aвтор", "aвторы",
    "автор (никнейм)", "фамилия имя автора", "фио автора",
    "фамилия автора", "фамилии автора", "имя автора", "имена автора",
    "фамилия и имя автора", "фамилии авторов",
    "исполнитель", "исполнители", "читает", "текст читает", "чтец",
    "автор и исполнитель", "жанр", "жанры", "прочитано по изданию",
    "тип", "тип издания", "категория", "формат", "язык", "страна",
    "аудиокодек", "аудио кодек", "битрейт", "битрейт аудио", "вид битрейта",
    "частота дискретизации", "количество каналов (моно-стерео)",
    "время звучания", "продолжительность", "продолжительность общая", "описание",
    "доп. информация", "другие версии", "другие раздачи",
    "цикл/серия", "цикл", "серия", "номер книги", "номер в серии", "№ книги",
]

# Words that are not people.
PEOPLE_NOISE = [
    "преподобный", "архимандрит", "диакон", "митрополит", "епископ", "архиепископ",
    "протоиерей", "иеромонах", "священник", "отец", "др", "др.", "другие",
    "подробности далее", "ученый каббалист", "учёный каббалист",
]
PERSON_TOKEN_NOISE = [
    "и", "др", "and", "et", "al", "академик", "профессор", "митрополит", "епископ",
    "архиепископ", "архимандрит", "протоиерей", "иеромонах", "монах", "священник", "отец",
]
TITLE_PREFIX_NOISE = [
    "сборник", "сборники", "аудиокнига", "аудиокниги", "радиоспектакль", "радиоспектакли",
]
NARRATOR_IS_AUTHOR = ["автор", "читает автор", "чтец автор", "исполняет автор"]
COLLECTIVE_CREDITS = [
    "заслуженные и народные артисты россии", "разные исполнители", "участники конкурса",
]
GENERIC_GENRES = ["аудиокнига", "audiobook"]
SURNAME_MARKER = "ли"

# Patterns of people credits.
# A title that announces itself.
ANNOUNCED_TITLE = r"(?iU)^.*?\bаудиокнига\s*[:.]\s*"
SERVICE_MARKER = r"(?iU)\s*\(\s*ли\s*\)\s*$"
AND_OTHERS = r"(?iU)\s+и\s+др\.?\s*$"
AUTHOR_PERIOD = r"(?iU)^(?:до|с|по|после)\s+(?:\d{1,2}|[IVXLCDM]+)\s*(?:век(?:а|ов)?|в\.)$"
AUTHOR_LEADING_LABEL = r"(?U)^(?iu:автор\s+стихов\s+и\s+текста)\s*[-–—:]*\s*(?=[A-ZА-ЯЁ])"
AUTHOR_LEADING_WORD = r"(?U)^[Аа]втор\s+(?=[A-ZА-ЯЁ])"
AUTHOR_LEADING_TITLE = r"(?U)^(?iu:профессор|академик)\s+(?=[A-ZА-ЯЁ])"
AUTHOR_ROLE = r"(?iU)\s+[-–—]\s+(?:идея|стихи|текст|сценарий|составитель)\s*$"
AUTHOR_TRANSLATOR = r"(?iU)\s*\(\s*(?:перевод|пер\.)\b[^()]*\)\s*$"
HONORIFIC = (r"(?iU)^(?:(?:(?:заслуженн(?:ый|ая|ые)|народн(?:ый|ая|ые))\s+|(?:засл|нар)\.\s*)"
             r"артист(?:ка|ы)?(?:\s+(?:РФ|России|СССР))?)\s*[,;:—–-]*\s*")
NARRATOR_NOT_READER = r"(?iU)^(?:(?:синхронный\s+)?перевод(?:чик|чики)?\b|реж(?:исс[её]р)?\.?\s*[:：])"
NARRATOR_ROLE_LABEL = r"(?iU)^(?:акт(?:ер|ёр|риса)?\.?|лектор|диктор)\s*[:：]\s*"
NARRATOR_FROM_AUTHOR = r"(?iU)^от\s+автора\s*[-–—:：]\s*"
NARRATOR_RADIO_PLAY = r"(?iU)^радиопостановка\b"
NARRATOR_READS = r"(?iU)^(?:коран\s+читает|читает\s+и\s+по[её]т|читает)\s+"
NARRATOR_TAIL = r"(?iU)(?:\.\s*музыка\b|\s+-\s+(?:читает|исполняет|передразнивает)\b).*$"
CAST_HEADS = ["исполнители", "в ролях", "действующие лица и исполнители"]
CAST_STOP = (r"(?iU)^(?:премьера\b|автор\s+радиоверсии\b|режисс[её]р(?:-постановщик)?\b|композитор\b|"
             r"звукорежисс[её]р(?:ы)?\b|шеф-редактор\b|редактор\b|продюсер\b|"
             r"при\s+финансовой\s+поддержке\b|набор\s+в\s+группу\b|помощь\s*\|\s*донаты\b)")
CAST_SKIP = r"(?iU)^(?:в эпизодах|музыка\b|оркестр\b)"
SCREENPLAY_CREDIT = r"(?imU)(?:^|:\s*)авторы?\s+сценария\s*[:：]\s*([^\n.]{3,240})"
JOINT_CREDIT_BLOCK = r"(?isU)(?:^|\n)\s*автор\s+и\s+исполнитель\s*(?:\n\s*)?[:：]\s*(.+?)(?=\n\s*жанр\s*(?:\n\s*)?[:：])"
JOINT_CREDIT_LINE = r"(?imU)\bчитает\s+([^\n]+)"
TEXT_CREDIT = r"(?mU)^\s*(?iu:текст)\s*[:：]\s*(?:\n\s*)?([A-ZА-ЯЁ][A-Za-zА-Яа-яЁё'’-]{2,39})\.\s+(?=[A-ZА-ЯЁ])"
SERMON_TITLE = r"(?iU)^аудиопроповеди\s+пастора\s+(.+)$"
SERMON_BIOGRAPHY = r"(?U)(?iu:краткая\s+биография)\s*:\s*([А-ЯЁ][А-Яа-яЁё'-]+(?:\s+[А-ЯЁ][А-Яа-яЁё'-]+){1,3})"
AUTHORS_READ = r"(?iU)\[\s*читают\s+авторы(?:\s*[,;]|\s*\])"
TITLE_NARRATOR = r"(?iU)(?:^|[.!?;])\s*чтец\s+(.+?)\s*$"

# Patterns of titles.
RELEASE_META = (r"(?iU)(?:\b(?:19|20)\d{2}\b|\b(?:\d{2,4}\s*)?(?:k|к)(?:bps|bs)\b|"
                r"\b\d{2,4}\s*(?:кбит|кб\/с|kb\/s)\b|"
                r"\b(?:mp3|m4a|m4b|aac|ogg|opus|flac|wav|wma)\b|"
                r"\b(?:web|digital\s+release|cd|lossless)\b|"
                r"битрейт|аудиокниг|исполнител|читает|чтец)")
TITLE_TECH = (r"(?iU)(?:\b(?:mp3pro|mp3|мр3|m4a|m4b|aac|ogg|opus|flac|wav|wma)\b|"
              r"\brip\s+\d{2,4}\s*(?:kbps|kbit/s|kb/s|кбит/с|кб/с)?\b|"
              r"\b\d{2,4}\s*(?:kbps|kbit/s|kb/s|кбит/с|кб/с)\b)")
NAVIGATION_NOTE = r"(?U)\s*\+?\s*<[^<>]{1,80}>\s*$"
LOOSE_AUDIO_TAIL = (r"(?iU)(?:\s*,\s*(?:mp3|m4[ab]|aac|ogg|opus|flac|wav|wma|"
                    r"\d{2,4}\s*(?:kbps|кбит(?:/с)?|кб/с)))+\s*$")
EDITORIAL_TAIL = (r"(?iU)^(?:\([^()]{1,120}\)\s*)?(?:[-–—:]\s*)?(?:указан(?:а|о|ы)?|уточнен(?:а|о|ы)?|"
                  r"исправлен(?:а|о|ы)?|в официальном описании|официальн\w*|примечани\w*).*$")
GENERIC_SUBJECT_PREFIX = r"(?iU)^(?:сборники?|аудиокниги?|радиоспектакли?)\s*[-–—:]\s+"
ANONYMOUS_AUTHOR = r"(?iU)\b(?:имя\s+автора\s+не\s+раскрывается|автор\s+(?:неизвестен|не\s+указан))\b"
ANONYMOUS_PREFIX = r"(?iU)^.{2,80}?\s+[-–—]\s+(?=(?:аудиокнига|audio\s*book)\s+[«\"“])"
# Applied in this order: (name, pattern, replacement).
TITLE_RULES = [
    ("separator_row", r"(?U)\s*(?:=\s*){3,}", ". "),
    ("leaked_http", r"(?iU)^bad[ _-]*gateway\s*[-–—:]\s*", ""),
    ("release_type", r"(?iU)^(?:[-–—]\s*)?(?:аудиокнига|audio\s*book)(?:\s*[:：.]\s*|\s+(?=[«\"“]))", ""),
    ("collection_type", r"(?iU)^аудиосборник\s+(?=[«\"“])", ""),
    ("play_type", r"(?iU)\.\s*аудиоспектакль\s*$", ""),
    ("lecture_type", r"(?iU)^ислам\s*[-–—:]\s*(?=сборник\s+лекций\b)", ""),
    ("disc_note", r"(?iU)\s+[-–—]\s*CD\s+к\s+книге\s*$", ""),
]
RELEASE_TYPE_GROUP = r"(?iU)\s*\(\s*(?:аудиокнига|аудиоспектакль|аудиожурнал|audio\s*book)\s*\)"
RELEASE_TYPE_CODEC = (r"(?iU)\s+(?:аудиокнига|audio\s*book)\s+"
                      r"(?=(?:mp3pro|mp3|мр3|m4a|m4b|aac|ogg|opus|flac|wav|wma|rip\b))")
YEAR_TAIL = r"(?iU)(?:,\s*|\s+)(?:19|20)\d{2}\s*г?\.?\s*,?\s*$"
TRANSLITERATION_TAIL = r"(?iU)^(.+\b(?:коран|qur(?:['’])?an))\s*/\s*[A-Z][A-Za-z ._'’\-]{2,80}$"
EBOOK_TAIL = r"(?iU)\s*\+\s*(?:DOC|DOCX|FB2|EPUB|MOBI|PDF)(?:\s*,\s*(?:DOC|DOCX|FB2|EPUB|MOBI|PDF))*\s*$"
PERFORMANCE_SUBJECT = r"(?iU)^\([^)]*(?:audio|musical|performance)[^)]*\)\s*VA\s*[-–—]"

# Patterns of series names and entries.
SERIES_NEXT_FIELD = (
    r"(?iU)\s+(?=(?:номер\s+(?:книги|в\s+(?:серии|цикле))|№\s*книги|жанр(?:ы)?|издательство|категория|"
    r"аудиокодек|кодек|битрейт|вид\s+битрейта|качество|время\s+звучания|общее\s+время\s+звучания|"
    r"продолжительность|описание|доп\.?\s*информация|дополнительная\s+информация|год\s+выпуска|"
    r"автор(?:ы)?|исполнитель(?:и)?|читает|чтец|возрастн(?:ое|ые)\s+ограничени(?:е|я))\s*[:：])")
SERIES_LABEL_ONLY = [
    "номер книги", "номер в серии", "номер в цикле", "№ книги", "жанр", "жанры", "издательство",
    "категория", "аудиокодек", "кодек", "битрейт", "вид битрейта", "качество", "время звучания",
    "общее время звучания", "продолжительность", "описание", "доп. информация",
    "дополнительная информация", "год выпуска", "автор", "авторы", "исполнитель", "исполнители",
    "читает", "чтец",
]
SERIES_LABEL_PREFIX = r"(?iU)^/?(?:цикл\s*/\s*серия|серия\s*/\s*цикл|серия|цикл)\s*(?:[:：\-]\s*)?"
SERIES_HEADING = (r"(?iU)^(?:цикл\s*/\s*серия|серия|цикл|книги\s+цикла|книги\s+серии|произведения\s+цикла|"
                  r"произведения\s+серии)\s*(?:[:：\-]\s*)?(.+?)$")
SERIES_HEADING_NOTE = r"(?iU)\s*\((?:вышедшие|изданные|опубликованные)\b[^()]*\)\s*$"
SERIES_FIELD_LINE = r"(?iU)^(?:цикл\s*/\s*серия|цикл|серия)\s*[:：]"
SERIES_LIST_TAIL = r"(?iU)(?:содержание|книги|произведения)\s+(?:цикла|серии)\s*[:：]?\s*$"
SERIES_NAMED_CYCLE = r"(?iU)(?:^|[:：]\s*)цикл\s*[«\"“](.+?)[»\"”]\s*[:：]?\s*$"
SERIES_READING_ORDER = r"(?iU)\bперечень\s+в\s+порядке\s+(?:озвучания|чтения)\b"
SERIES_WHOLE_CYCLE = r"(?iU)^(?:весь\s+)?(?:под)?цикл\b.*(?:раздач|аудиокниг)"
SERIES_NUMBERED_LINE = r"(?U)^(?:[📘📗📙📕📚]\s*)?(\d{1,3})[.)]\s*(.+)$"
ENTRY_CUTS = [
    r"(?iU)\s+https?://.*$",
    r"(?iU)\s+(?:описание|доп\.?\s*информация)\s*[:：].*$",
    r"(?iU)\s*//\s*автор\s*[:：].*$",
    r"(?iU)\s*,?\s+в\s+исполнении\s+.*$",
    r"(?iU)\s+книги\s+цикла\s+на\s+трекере\b.*$",
    r"(?U)\s+\*(?=\S).*$",
    r"(?iU)\s*[-–—]?\s*(?:данн(?:ый|ая)\s+(?:релиз|раздача|аудиокнига|книга)|эта\s+раздача)\s*$",
    r"(?iU)\s*[;,]?\s*книга\s+вышла\b.*$",
    r"(?iU)\s*[;,]?\s*т\s*\.?\s*е\s*\.?\s+как\s+раз\s+перед\s+событиями\s+романа\b.*$",
]
THIS_RELEASE_NOTE = "данный релиз"
NON_ENTRY = (r"(?iU)(?:\.(?:mp3|m4[ab]|aac|ogg|opus|flac|wav|wma)\b|\b(?:bitrate|продолжительность)\b|"
             r"\b\d{2,4}\s*(?:kbps|кбит|кб/с|kb/s)\b|[\[(]\d{1,3}:\d{2}(?::\d{2})?[\])]\s*$|"
             r"^(?:\d{1,2}\.)?\d{1,2}\.\d{4}\s+.*"
             r"(?:перезалит|добавлен|обновлен|обновлён|исправлен|заменен|заменён))")
POSITION_MARKER = (r"(?iU)(?:книга|том|часть|серия)\s*(?:№|#)?\s*[-–—.:]?\s*"
                   r"([0-9]{1,3}|[IVXLCDMХВ]{1,8})(?=\b|\s|[.:,;!?)]|$)")
POSITION_WORD = r"(?iU)\b(?:книга|том|часть)\s*(?:№\s*)?0*(\d{1,3})\b"

# Patterns of measures.
DURATION_LABEL = r"(?iU)\b(?:общее(?:\s+время)?\s+звучани[ея]|продолжительность)\b\s*[:\-]?\s*.{0,80}"

# Texts that state the last page of a listing.
LAST_PAGE_TEXTS = [
    r"(?iU)страниц(?:а|ы)?\s*[:：]?\s*(\d+)",
    r"(?iU)страница\s+\d+\s+из\s+(\d+)",
    r"(?iU)page\s+\d+\s+of\s+(\d+)",
]

# Site suffixes cut from page titles (the site's own name is a parameter).
TITLE_SUFFIXES = [r"(?iU)\s*[-—|]?\s*аудиокнига(?:\s+бесплатно!?|\s+слушать.*|\s+онлайн.*)?$"]

# Thresholds.
TOKEN_SIMILARITY = 0.84
TITLE_OVERLAP = 0.67
LEGACY_SHARED_TOKENS = 4
LEGACY_OVERLAP = 0.6
CONTENTS_MAX_ROWS = 50
CONTENTS_ZERO_ROWS = 10
CONTENTS_CREDIT_ROWS = 6
CONTENTS_CREDIT_SHARE = 0.7
