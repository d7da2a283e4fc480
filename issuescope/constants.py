"""Values fixed by the data formats the library reads and writes."""

# --- Fixed values: accepted column names per role; the first one present wins ---
TITLE_COLUMN = "Заголовок"
LINK_COLUMN = "Ссылка"
PROBLEM_COLUMNS = ("проблема", "problem", "Проблема")
PROBLEM_RU_COLUMNS = (
    "problem_russ",
    "problem_rus",
    "problem_ru",
    "проблема_ru",
    "проблема_rus",
    "проблема_рус",
    "проблема_перевод",
    "проблема (ru)",
    "перевод_проблемы",
)
MESSAGE_COLUMNS = ("Сообщение", "Сообщения", "сообщение", "text", "Текст")

# --- Fixed values: texts a CSV cell may hold for "no value" (the pandas default list) ---
NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- Fixed value: the answer that means "no label fits" ---
NO_LABEL = "нет"

# --- Fixed values: characters removed by a Unicode strip, and the line breaks ---
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
LINE_BREAK = r"[\n-\r\x1C-\x1E\x{85}\x{2028}-\x{2029}]"

# --- Fixed values: synonyms of each merged category, in order of priority ---
SYNONYM_GROUPS = (
    (
        "Экология, климат и загрязнение",
        (
            "экологические проблемы",
            "экология",
            "загрязнение воздуха и воды",
            "загрязнение воздуха",
            "загрязнение воды",
            "изменение климата",
            "климатические изменения",
            "засуха",
            "засухи",
        ),
    ),
    (
        "Электроэнергия: сбои и высокая стоимость",
        (
            "сбои электроснабжения",
            "перебои с электричеством",
            "стоимость электроэнергии",
            "проблемы с электроэнергией (сбои, высокая стоимость, дефицит)",
            "электроэнергия",
        ),
    ),
    (
        "Жильё: условия и высокая стоимость",
        (
            "жилищные условия",
            "высокие цены на жильё и аренду",
            "плохие жилищные условия и высокая стоимость жилья",
        ),
    ),
    (
        "Инфляция и рост цен (продукты, топливо)",
        (
            "инфляция",
            "инфляция и рост цен",
            "высокие цены на продукты",
            "высокие цены на топливо",
        ),
    ),
)

# --- Fixed values: English label -> Russian label ---
LABEL_DICTIONARY = (
    ("Unemployment", "Безработица"),
    ("Informal sector", "Неформальный сектор"),
    ("Precarious employment", "Нестабильная занятость"),
    ("Inflation", "Инфляция"),
    ("Poverty", "Бедность"),
    ("Inequality", "Неравенство"),
    ("Undernourishment", "Недоедание"),
    ("Malnutrition", "Недостаточное питание"),
    ("Access to water", "Доступ к воде"),
    ("Sanitation", "Санитария"),
    ("Inadequate housing", "Неадекватное жильё"),
    ("Urbanization", "Урбанизация"),
    ("Pollution", "Загрязнение"),
    ("Deforestation", "Обезлесение"),
    ("Climate change", "Изменение климата"),
    ("Drought", "Засуха"),
    ("Floods", "Наводнения"),
    ("Corruption", "Коррупция"),
    ("Poor governance", "Плохое управление"),
    ("Political instability", "Политическая нестабильность"),
    ("Insecurity", "Небезопасность"),
    ("Conflicts", "Конфликты"),
    ("Forced displacement", "Вынужденное переселение"),
    ("Child labor", "Детский труд"),
    ("Early marriage", "Ранние браки"),
    ("Domestic violence", "Домашнее насилие"),
    ("Discrimination", "Дискриминация"),
    ("Access to education", "Доступ к образованию"),
    ("Illiteracy", "Безграмотность"),
    ("Youth underemployment", "Недоиспользование труда молодёжи"),
    ("Weak healthcare system", "Слабая система здравоохранения"),
    ("Infant mortality", "Детская смертность"),
    ("Epidemics", "Эпидемии"),
    ("Cost of healthcare", "Стоимость медицинских услуг"),
    ("Medicine shortage", "Недостаток лекарств"),
    ("Degraded infrastructure", "Разрушенная инфраструктура"),
    ("Limited transportation", "Ограниченный транспорт"),
    ("Lack of electricity", "Отсутствие электричества"),
    ("Energy shortage", "Дефицит энергии"),
    ("Limited internet access", "Ограниченный доступ к интернету"),
    ("Brain drain", "Утечка мозгов"),
    ("Low investment", "Низкие инвестиции"),
    ("Economic dependence", "Экономическая зависимость"),
    ("Public debt", "Государственный долг"),
    ("Limited exports", "Ограниченный экспорт"),
    ("Price fluctuation", "Колебания цен"),
    ("Unstable market", "Нестабильный рынок"),
    ("Weak tourism", "Слабый туризм"),
    ("Mining exploitation", "Добыча полезных ископаемых"),
    ("Unproductive agriculture", "Малопродуктивное сельское хозяйство"),
)

# --- Fixed values: country names in the genitive, for report titles ---
COUNTRY_DISPLAY = (("Tanzania", "Танзании"),)

# --- Fixed values: USD per million tokens (model, input, output) ---
MODEL_PRICES = (("gpt-4.1-mini", 0.40, 1.60), ("gpt-4.1", 2.00, 8.00))
CLASSIFY_MODEL = "gpt-4.1-mini"
WRITER_MODEL = "gpt-4.1"

# --- Fixed values: default limits ---
MAX_LABELS = 3
MAX_MESSAGES = 30
NOTED_MAX_MESSAGES = 15
MAX_MESSAGE_CHARS = 2000
MAX_LINKS = 3
SINGLE_LABEL_CHARS = 2000
SECTION_TEMPERATURE = 0.2
SECTION_MAX_TOKENS = 5000
CLASSIFY_MAX_TOKENS = 800
SINGLE_LABEL_MAX_TOKENS = 10
TRANSLATE_MAX_TOKENS = 2000

# --- Fixed values: headings and line formats of a section text ---
QUOTES_HEADING = "цитаты"
SOURCES_HEADING = "источники"
HEADING_WORDS = ("описание проблемы", "пример", "цитаты", "источники")
HEADING_PATTERN = r"(?iU)^(описание проблемы\s*:?|пример\s+\d+\s*:?|цитаты\s*:?|источники\s*:?)$"
BULLETS = ("- ", "— ", "• ")
OPENING_QUOTES = ('"', "«", "“", "„", "'", "‚")
CONCLUSION_PREFIX = "вывод"

# --- Fixed values: texts of the report frame ---
REPORT_TITLE = (
    "Проблемное поле жителей {country}: тематический анализ на основании материалов социальных сетей "
    "и электронных медиа"
)
REPORT_DATE_LINE = "Дата формирования отчёта: "
TOC_HEADING = "Оглавление"
DESCRIPTION_HEADING = "Описание исследования"
DISTRIBUTION_HEADING = "Распределение проблем"
DISTRIBUTION_COLUMNS = ("Проблема", "Количество")
SOURCES_TITLE = "Источники"
NOTED_REPORT_TITLE = "Проблемы жителей {country}: тематический анализ"
NOTED_SOURCES_TITLE = "Источники и материалы:"
NOTED_FAILED_TEXT = "Не удалось получить анализ из модели. Ошибка: "
FAILED_SECTION_TEXT = "Не удалось получить анализ. Ошибка: "
