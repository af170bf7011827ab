"""Values that results depend on: word lists, thresholds, labels and limits."""

# --- fixed values: scoring ---------------------------------------------------
DEFAULT_THRESHOLD = 0.75

STRICT_THRESHOLDS = {
    "BBCNews": 0.90,
    "CBSNews": 0.90,
    "APNews": 0.93,
    "ReutersWorld": 0.93,
    "NYTimesWorld": 0.93,
    "NPRNews": 0.93,
    "GuardianWorld": 0.93,
    "AlJazeeraAll": 0.93,
}

BASE_HINTS = (
    "wins", "win", "rescued", "recovery", "breakthrough", "improves",
    "helped", "helps", "saved", "donates", "charity", "volunteer",
    "uplifting", "success", "record high", "celebrates", "hope", "positive",
)

EXTRA_POSITIVE_HINTS = (
    "award", "achievement", "reunited", "healed", "milestone",
    "historic", "discover", "partnership", "innovative", "growth",
    "inspiring", "grateful", "joy", "kind", "peace",
)

NEGATIVE_HINTS = (
    "kill", "killed", "dead", "death", "crash", "war", "attack",
    "tragedy", "disaster", "crisis", "terror", "violence", "arrested",
    "fire", "flood", "explosion", "murder", "wounded",
)

SCORE_BASE = 0.1
SCORE_PER_POSITIVE = 0.65
SCORE_PER_NEGATIVE = 0.15

# --- fixed values: categories ------------------------------------------------
TOPICS = (
    "Health", "Environment", "Community", "Science & Tech", "Education",
    "Sports", "Arts & Culture",
)

MODEL_TOPICS = (
    "Arts & Culture", "Community", "Education", "Environment", "Health",
    "Science & Tech", "Sports", "World",
)

# name, slug, description, icon, colour
CATEGORY_SEED = (
    ("Science & Tech", "science-tech",
     "Scientific discoveries, technology breakthroughs, and innovation", "🔬", "#3498db"),
    ("Health", "health",
     "Medical advances, wellness, and health recovery stories", "💊", "#2ecc71"),
    ("Environment", "environment",
     "Environmental conservation, wildlife protection, and sustainability", "🌍", "#27ae60"),
    ("Community", "community",
     "Human kindness, volunteering, charity, and community support", "🤝", "#e74c3c"),
    ("Education", "education",
     "Educational achievements, scholarships, and learning opportunities", "📚", "#f39c12"),
    ("Sports", "sports",
     "Athletic achievements, inspiring sports stories, and competitions", "⚽", "#9b59b6"),
    ("Arts & Culture", "arts-culture",
     "Creative expression, cultural celebrations, and artistic achievements", "🎨", "#1abc9c"),
)

# labels of earlier runs -> label of today
LEGACY_TOPICS = {
    "Health & Wellness": "Health",
    "Environment & Nature": "Environment",
    "Community & Social Good": "Community",
    "Technology & Science": "Science & Tech",
    "Business & Economics": "Science & Tech",
    "Culture & Arts": "Arts & Culture",
    "Human Interest": "Community",
}

# --- fixed values: text limits -----------------------------------------------
BODY_CHARS_FOR_TOPICS = 500
BODY_CHARS_FOR_SUMMARY = 3800
TITLE_CHARS_IN_EVENTS = 120
SUMMARY_MIN_WORDS = 30
SUMMARY_MAX_WORDS = 130

# --- fixed values: links and pages -------------------------------------------
REDDIT_DOMAINS = ("reddit.com", "redd.it", "i.redd.it", "v.redd.it")
REDDIT_GALLERY = "reddit.com/gallery"
IMAGE_META_NAMES = ("og:image", "twitter:image", "twitter:image:src")

# --- fixed values: registry --------------------------------------------------
REQUIRED_SOURCE_FIELDS = ("name", "source_id", "rss_url")
KNOWN_ADAPTERS = ("reddit", "rss")
DEFAULT_ADAPTER = "rss"
