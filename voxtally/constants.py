"""Values that results depend on."""

# First day of the reporting period, batch sizes, phrases per topic and side, retry settings.
MIN_DATE = "2025-11-01"
EXTRACTION_BATCH = 50
EXTRACTION_LIMIT = 3
SUBTOPIC_BATCH = 150
SURVEY_BATCH = 150
TRANSLATION_BATCH = 20
CLEANUP_BATCH = 125
RETRIES = 3
BACKOFF_SECONDS = 2.0

# Enumerations of the model replies.
SENTIMENTS = ("positive", "neutral", "negative")
POST_LABELS = ("AIRLINE", "AIRPORT", "OTHER")
POST_ENTITIES = ("saudia", "flynas", "flyadeal", "RUH", "JED", "DMM", "Unknown")
PAIN = "Pain Point"
DELIGHT = "Moment of Delight"
OTHERS = "Others"

# Modifiers that carry no information of their own.
GENERIC_MODIFIERS = ("poor experience with", "great experience with")

# Topic names merged in the airport table.
AIRPORT_TOPIC_RENAMES = {
    "Baggage": "Baggage Services",
    "Baggage Services - Airports": "Baggage Services",
}

# Place name to airport code.
PLACE_CODES = {
    "King Khalid International Airport": "RUH",
    "King Fahd International Airport": "DMM",
    "King Abdulaziz International Airport": "JED",
}

# Language code to language name.
LANGUAGE_NAMES = {
    "en": "English", "ar": "Arabic", "es": "Spanish", "fr": "French",
    "de": "German", "it": "Italian", "pt": "Portuguese", "tr": "Turkish",
    "ru": "Russian", "zh": "Chinese", "ja": "Japanese", "ko": "Korean",
    "nl": "Dutch", "ur": "Urdu", "fa": "Persian", "hi": "Hindi",
    "ro": "Romanian", "hu": "Hungarian", "pl": "Polish", "sv": "Swedish",
    "da": "Danish", "fi": "Finnish", "no": "Norwegian", "id": "Indonesian",
    "ms": "Malay", "th": "Thai", "af": "Afrikaans", "ca": "Catalan",
    "cy": "Welsh", "el": "Greek", "bn": "Bengali", "fil": "Filipino",
    "hr": "Croatian", "iw": "Hebrew", "so": "Somali", "uz": "Uzbek",
    "zh-hant": "Chinese (Traditional)",
}

# Keyword rules for social posts, in the order in which they are tried.
KEYWORD_RULES = (
    ("AIRPORT", "RUH", (
        "riyadh", "الرياض", "مطار الرياض", "الملك خالد", "king khalid", "ruh",
        "مطار خالد", "Terminal 4", "تيرمينال", "@kkia", "@riyadhairport",
    )),
    ("AIRPORT", "JED", (
        "jeddah", "jedda", "جدة", "مطار جدة", "الملك عبدالعزيز",
        "king abdulaziz", "jed", "مطار عبدالعزيز", "@kaia_jeddah",
    )),
    ("AIRPORT", "DMM", (
        "dammam", "الدمام", "مطار الدمام", "الملك فهد", "king fahd",
        "dmm", "مطار فهد", "@kfiairport", "kfia",
    )),
    ("AIRLINE", "saudia", (
        "saudia", "saudi airlines", "saudi arabian airlines", "الخطوط السعودية",
        "سعودية", "خطوط سعودية", "الخطوط", "@saudiairlines", "@saudi_airlines",
        "saudi_airlines", "sv", "saudiairlines",
    )),
    ("AIRLINE", "flynas", (
        "flynas", "fly nas", "طيران ناس", "فلاي ناس", "ناس", "@flynas", "nas air",
    )),
    ("AIRLINE", "flyadeal", (
        "flyadeal", "fly adeal", "طيران أديل", "طيران اديل", "فلاي ديل",
        "أديل", "اديل", "@flyadeal",
    )),
    ("AIRPORT", "Unknown", (
        "مطار", "airport", "terminal", "صالة", "صالة المغادرة", "صالة الوصول",
        "وصول", "مغادرة", "arrivals", "departures", "gate", "بوابة",
        "موقف", "parking", "جوازات", "immigration", "جمارك", "customs",
        "check-in", "تسجيل وصول", "baggage claim", "استلام الامتعة",
    )),
    ("AIRLINE", "Unknown", (
        "flight", "رحلة", "طيران", "airline", "خطوط", "تذكرة", "ticket",
        "حجز", "booking", "boarding", "صعود", "delay", "تأخير",
        "luggage", "baggage", "امتعة", "شنطة", "crew", "طاقم",
        "captain", "كابتن", "seat", "مقعد", "class", "درجة",
        "compensation", "تعويض", "refund", "استرداد",
    )),
)
NO_RULE = ("OTHER", "Unknown")

# Column order of the two dashboard tables.
AIRLINE_COLUMNS = (
    "Review_No", "sentiment", "topic", "pp_mod", "subtopic", "type",
    "data_source", "airline", "date", "rating",
    "Original Review Language", "Original Review", "Translated Review",
)
AIRPORT_COLUMNS = (
    "Review_No", "sentiment", "topic", "pp_mod", "type",
    "Airport", "date", "rating", "data_source",
    "Original Review Language", "Original Review", "Translated Review",
    "subtopic",
)

# Frequent function words per Latin-script language (own selection).
STOP_WORDS = {
    "en": "the of and to a in is that it for was with be by this are from not have you at on they we were or an as he",
    "fr": "de le la les et des du un une en est que qui pour dans pas par sur avec au ne ce il je vous nous",
    "de": "der die und in den von zu das mit sich des auf ist nicht für ein eine dem im als auch es wir ich",
    "es": "de la el los las que y en un del se por con una su para al lo como más pero sus este es muy no",
    "it": "il di la e che è per un una sono con non del della gli alla nel anche ho più ma molto",
    "pt": "de a e que o os do da em um uma não com para por mais dos das ao foi muito são ele você",
    "nl": "het een van en de dat niet zijn met voor op aan er maar ook bij naar wij ik was",
    "tr": "ve bir bu için ile çok da de daha olarak gibi ama ne kadar sonra değil var ben",
    "sv": "och att det som en på är av för med den till inte har jag ett om men var",
    "da": "og at det som en på er af for med den til ikke har jeg et om men der",
    "no": "og at det som en på er av for med den til ikke har jeg et om men fra",
    "fi": "ja on ei että se oli hän mutta kun niin ovat myös kuin joka tämä olen",
    "pl": "i w na z się nie do to że jest o jak ale po co przez był dla",
    "ro": "și în de la cu pe nu este care din mai sunt un să pentru ce dar",
    "hu": "a az és hogy nem is egy volt meg ez de csak már mint van",
    "hr": "i je u na se da za su od ne što kao ali nije bio iz",
    "id": "yang dan di dari untuk dengan pada ini itu tidak adalah saya ke akan ada",
    "af": "die en van het is nie in dat vir met op wat ek was om",
    "ca": "el la els les i de que en per amb un una no és són del al molt però això",
    "cy": "y yr a i yn o ar mae gan am wedi ei eu fod bod",
    "so": "iyo waa in ka ku oo la ay u ah uu ayaa soo si",
    "uz": "va bu bir bilan uchun ham edi deb emas bo'lgan lekin",
    "fil": "ang ng sa na mga ay at ko ito hindi para niya kung",
}

# Fixed value: the code fence around a reply.
FENCE = r"^```[a-zA-Z]*\n|\n```$"
