"""These must equal the originals for results to agree.

Word lists, lookup points, numbers and names that the data producers and the readers of the
results already rely on. They are defaults only; every operator takes its own values.
"""

# --- Topics: the first list with a match wins, in this order; no match gives DEFAULT_TOPIC.
UNEMPLOYMENT_WORDS = (
    "بطالة", "وظيفة", "شغل", "عمل", "عاطل", "راتب", "توظيف", "سيرة ذاتية", "ديوان الخدمة",
    "سوق العمل", "فرصة عمل", "شواغر", "مقابلة", "واسطة", "خريج", "لينكد", "hr", "خبرة",
    "عقد", "تسريح", "قطاع خاص", "قطاع عام", "دوام", "مسمى وظيفي", "تدريب",
)
ANXIETY_WORDS = (
    "قلق", "خوف", "توتر", "اكتئاب", "نفسية", "ضغط", "أرق", "تفكير", "انهيار", "هلع",
    "مخنوق", "صدمة", "عزلة", "وسواس", "احتراق", "overthinking", "panic", "يأس", "وحدة",
    "صداع", "قولون", "خيبة", "مشاعر سلبية", "فقدان شغف",
)
ECONOMY_WORDS = (
    "غلاء", "سعر", "فلوس", "اقتصاد", "ضريبة", "ذهب", "دولار", "قرض", "ديون", "مصاريف",
    "فقر", "تضخم", "قوة شرائية", "تعويم", "صرف", "فاتورة", "كهرباء", "بنزين", "اقساط",
    "جمعيات", "مصروف", "استثمار", "ركود", "ايجار", "مالية",
)
UNEMPLOYMENT, ANXIETY, ECONOMY, DEFAULT_TOPIC = "Unemployment", "Anxiety", "Economy", "General"

# --- Sentiment words of the survey stream.
POSITIVE_WORDS = ("متفائل", "تمام", "الحمد لله", "أفضل", "أمل", "سعيد", "ان شاء الله")
NEGATIVE_WORDS = ("قلق", "صعب", "متوتر", "ضيق", "مرهق", "قلقان", "مكتئب")
POSITIVE, NEGATIVE, NEUTRAL = "positive", "negative", "neutral"

# --- Message categories (case-sensitive, first match wins).
CATEGORY_WORDS = (
    ("اقتصادية", ("سعر", "غلاء", "راتب", "فلوس", "مال", "سوق", "تكلفة")),
    ("صحية", ("مرض", "علاج", "مستشفى", "دواء", "صحة", "تعب", "طبيب")),
    ("اجتماعية", ("عائلة", "زواج", "أصدقاء", "ناس", "مجتمع", "زيارة")),
    ("عمل", ("وظيفة", "شغل", "مدير", "دوام", "شركة", "مشروع")),
)
DEFAULT_CATEGORY = "عامة"

# --- Keyword extraction.
STOPWORDS = (
    "في", "من", "الى", "على", "أن", "إن", "ما", "هذا", "و", "أو", "عن", "مع", "كان", "انا",
)
KEYWORDS_PER_MESSAGE = 5
LONGEST_DROPPED_WORD = 2

# --- Places: country, latitude, longitude; unknown countries fall on the first.
COUNTRY_POINTS = (
    ("Jordan", 31.95, 35.91),
    ("Saudi Arabia", 24.71, 46.67),
    ("Egypt", 26.82, 30.80),
    ("UAE", 23.42, 53.84),
    ("Lebanon", 33.85, 35.86),
    ("Kuwait", 29.37, 47.97),
)
DEFAULT_COUNTRY = "Jordan"

# --- Message defaults.
UNSPECIFIED = "غير محدد"
DEFAULT_AGE = 0
ENGINE_TAG = "Spark NLP"

# --- Working sets, series and rules.
NEWEST_MESSAGES = 10_000
RETAINED_MESSAGES = 500
FEED_MESSAGES = 5
SAMPLE_ROWS = 3
HISTORY_POINTS = 50
HISTORY_PADDING = 20
FIT_POINTS = 15
FORECAST_STEPS = 10
SPIKE_FACTOR = 1.5
SPIKE_FLOOR = 5
ADVICE_RULES = (
    (UNEMPLOYMENT, 10, "Labor Ministry", "High unemployment mentions detected."),
    (ANXIETY, 10, "Health Ministry", "Anxiety levels rising."),
)
STABLE_ADVICE = "Stable."

# --- Message bus and payload text formats.
SOCIAL_TOPIC = "social-media-data"
SURVEY_TOPIC = "mental_health_live"
EMPLOYMENT_TOPIC = "employment_indicators"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
CLOCK_FORMAT = "HH:mm:ss"
