"""Fixed values the rules and feature lists are defined by."""

# --- fixed values: feature lists -------------------------------------------

CAST_FEATURES = ["num_cast_members", "avg_cast_popularity", "max_cast_popularity", "star_power_score"]
DIRECTOR_FEATURES = ["num_directors", "avg_director_popularity", "max_director_popularity", "director_experience_score"]
COMPOSER_FEATURES = ["num_composers", "avg_composer_popularity", "max_composer_popularity", "music_prestige_score"]
PEOPLE_FEATURES = CAST_FEATURES + DIRECTOR_FEATURES + COMPOSER_FEATURES

MODEL_FEATURES = [
    "budget", "runtime", "popularity", "vote_average", "vote_count",
    "trailer_views", "trailer_likes", "trailer_comments",
    "trailer_popularity_index", "interaction_rate", "engagement_velocity",
    "youtube_sentiment", "sentiment_volatility", "trend_momentum",
    "num_cast_members", "avg_cast_popularity", "max_cast_popularity", "star_power_score",
    "avg_cast_historical_roi",
    "num_directors", "avg_director_popularity", "max_director_popularity", "director_experience_score",
    "num_composers", "avg_composer_popularity", "max_composer_popularity", "music_prestige_score",
    "is_franchise", "is_sequel", "budget_tier", "genre_avg_revenue",
    "description_length", "hype_score", "budget_popularity_ratio", "vote_power",
    "overview", "primary_genre", "release_month",
]
TEXT_FEATURES = ["overview"]
CATEGORICAL_FEATURES = ["primary_genre", "release_month"]
NUMERIC_FEATURES = [c for c in MODEL_FEATURES if c not in TEXT_FEATURES + CATEGORICAL_FEATURES]

FEATURE_GROUPS = {
    "financial": ["budget", "budget_tier", "genre_avg_revenue"],
    "audience": ["popularity", "vote_average", "vote_count", "vote_power", "hype_score"],
    "trailer": ["trailer_views", "trailer_likes", "trailer_comments", "trailer_popularity_index"],
    "sentiment": ["youtube_sentiment", "sentiment_volatility", "trend_momentum"],
    "cast_crew": ["avg_cast_popularity", "max_cast_popularity", "star_power_score",
                  "avg_director_popularity", "max_director_popularity"],
    "engineered": ["is_franchise", "is_sequel", "budget_popularity_ratio", "description_length"],
}

# --- fixed values: cue phrases and key words -------------------------------

LOW_QUALITY_CUES = [
    "poorly explained", "thin character", "thin character arc", "inconsistent world-building",
    "clich", "cliches", "lacks tonal consistency", "tonal inconsistency", "rushed",
    "heavy exposition", "leans on exposition", "exposition-heavy",
    "stakes never feel convincing", "low stakes", "little structure", "unclear role",
    "unrelated action scenes", "plot hole", "predictable", "generic", "formulaic",
    "flat dialogue", "wooden dialogue", "messy pacing", "underdeveloped",
    "confusing narrative", "no payoff", "forced humor", "cheap twist",
]

HIGH_QUALITY_CUES = [
    "tight screenplay", "well-structured", "strong character arc", "compelling arc",
    "cohesive world-building", "smart dialogue", "sharp dialogue", "nuanced performance",
    "emotional depth", "emotional resonance", "narrative tension", "clear stakes",
    "earned payoff", "original concept", "fresh premise", "inventive set pieces",
    "excellent pacing", "confident direction", "critically acclaimed", "award-winning",
    "festival favorite", "strong word of mouth", "high rewatch value", "well-reviewed",
    "cinematic craftsmanship", "memorable score", "standout cinematography",
    "theatrical event", "global appeal", "franchise potential", "repeat-watch value",
    "practical action set pieces", "powerful orchestral score",
]

EVENT_CUES = [
    "theatrical event", "global appeal", "franchise potential",
    "large-scale action", "practical action set pieces", "orchestral score",
]

NONSENSE_PHRASES = [
    "test movie", "hello world", "nothing happens", "idk", "dont know", "asdf", "lorem ipsum",
]

FRANCHISE_KEYWORDS = [
    "avengers", "star wars", "harry potter", "lord of the rings", "hobbit",
    "fast & furious", "fast and furious", "furious", "jurassic", "minions",
    "despicable me", "toy story", "shrek", "frozen", "spider-man", "spider man",
    "batman", "superman", "wonder woman", "thor", "captain america", "iron man",
    "black panther", "deadpool", "guardians of the galaxy", "venom", "aquaman",
    "doctor strange", "pirates of the caribbean", "transformer", "mission: impossible",
    "mission impossible", "hunger games", "twilight", "ice age", "madagascar",
    "inside out", "zootopia", "moana", "lion king", "aladdin", "beauty and the beast",
    "joker", "top gun", "barbie", "minecraft", "lilo", "stitch", "wicked",
    "mario", "finding dory", "finding nemo", "coco", "fantastic beasts",
    "jumanji", "secret life of pets", "bohemian", "suicide squad",
    "captain marvel", "skyfall", "spectre", "no time to die", "inception",
    "interstellar", "the dark knight", "maleficent", "jungle book",
]

TENTPOLE_GENRES = ["action", "science fiction", "adventure"]

STOP_WORDS = [
    "the", "and", "for", "with", "that", "this", "from", "into", "about", "when",
    "where", "while", "will", "have", "has", "had", "are", "was", "were", "but",
    "not", "too", "very", "its", "his", "her", "their", "them", "they", "you",
    "your", "our", "out", "off", "who", "what", "why", "how",
]

# English words that carry no topic, for term weights.
ENGLISH_STOP_WORDS = [
    "a", "about", "above", "after", "again", "against", "all", "am", "an", "and", "any", "are", "as", "at", "be",
    "because", "been", "before", "being", "below", "between", "both", "but", "by", "can", "could", "did", "do", "does",
    "doing", "down", "during", "each", "few", "for", "from", "further", "had", "has", "have", "having", "he", "her",
    "here", "hers", "herself", "him", "himself", "his", "how", "i", "if", "in", "into", "is", "it", "its", "itself",
    "just", "me", "more", "most", "my", "myself", "no", "nor", "not", "now", "of", "off", "on", "once", "only", "or",
    "other", "our", "ours", "ourselves", "out", "over", "own", "same", "she", "should", "so", "some", "such", "than",
    "that", "the", "their", "theirs", "them", "themselves", "then", "there", "these", "they", "this", "those",
    "through", "to", "too", "under", "until", "up", "very", "was", "we", "were", "what", "when", "where", "which",
    "while", "who", "whom", "why", "will", "with", "would", "you", "your", "yours", "yourself", "yourselves",
]

# Phrase override: (required phrase, any of these, floor, base, multiplier, confidence on the phrase)
OVERRIDE_PHRASE = "inception"
OVERRIDE_ANY = ["nolan", "dream"]
OVERRIDE_BELOW = 300_000_000.0
OVERRIDE_BASE = 650_000_000.0
OVERRIDE_FACTOR = 2.0

# --- fixed values: text patterns -------------------------------------------

TOKEN_PATTERN = "[a-z0-9]+"
LONG_TOKEN_PATTERN = "[a-z0-9]{3,}"
SYNTHETIC_TITLE_PATTERN = r"^bad movie\s+\d+$"
NUMERIC_TEXT_PATTERN = r"^(?:\d+\.?\d*|\.\d+)$"
MONEY_PATTERN = r"(?i)\$[\d,]+(?:\s*million|\s*billion)?"
MONEY_DECIMAL_PATTERN = r"(?i)\$[\d,]+(?:\.\d+)?(?:\s*million|\s*billion)?"
BULLET_PATTERN = r"^[-•*]\s+"
NAME_PART = r"(?:[A-Z][a-z]+|[A-Z]\.)"
NAME_PART_INNER_CAPS = r"(?:[A-Z][a-z]+(?:[A-Z][a-z]+)*|[A-Z]\.)"
ROLE_LINE_PATTERN = (
    r"(?i)^(?:Director|Producer|Writer|Composer|Cinematography|Music|Starring|Cast|Main Cast|Crew):\s*(.*)"
)
NAME_SEPARATORS = r"[,&]|\s+and\s+"

# --- fixed values: bounds --------------------------------------------------

PEOPLE_BOUNDS = {
    "num_cast_members": (0, 30),
    "num_directors": (0, 5),
    "num_composers": (0, 10),
    "avg_cast_popularity": (0.0, 100.0),
    "max_cast_popularity": (0.0, 100.0),
    "star_power_score": (0.0, 5000.0),
    "avg_cast_historical_roi": (0.0, 20.0),
    "avg_director_popularity": (0.0, 100.0),
    "max_director_popularity": (0.0, 100.0),
    "director_experience_score": (0.0, 100.0),
    "avg_composer_popularity": (0.0, 100.0),
    "max_composer_popularity": (0.0, 100.0),
    "music_prestige_score": (0.0, 100.0),
}

# name -> (default, low, high)
SOCIAL_BOUNDS = {
    "youtube_sentiment": (5.0, 0.0, 15.0),
    "sentiment_volatility": (0.1, 0.0, 1.0),
    "trend_momentum": (0.0, -1.0, 1.0),
}

# Scoring record: name, Spark type, default (None = required).
RECORD_FIELDS = [
    ("title", "string", None),
    ("budget", "double", None),
    ("runtime", "int", 120),
    ("popularity", "double", 1.0),
    ("vote_average", "double", 5.0),
    ("vote_count", "int", 100),
    ("trailer_views", "bigint", 1000),
    ("trailer_likes", "bigint", 100),
    ("trailer_comments", "bigint", 10),
    ("trailer_popularity_index", "double", 0.1),
    ("interaction_rate", "double", 0.01),
    ("engagement_velocity", "double", 0.0),
    ("youtube_sentiment", "double", 5.0),
    ("sentiment_volatility", "double", 0.1),
    ("trend_momentum", "double", 0.0),
    ("num_cast_members", "int", 0),
    ("avg_cast_popularity", "double", 0.0),
    ("max_cast_popularity", "double", 0.0),
    ("star_power_score", "double", 0.0),
    ("avg_cast_historical_roi", "double", 0.0),
    ("num_directors", "int", 0),
    ("avg_director_popularity", "double", 0.0),
    ("max_director_popularity", "double", 0.0),
    ("director_experience_score", "double", 0.0),
    ("num_composers", "int", 0),
    ("avg_composer_popularity", "double", 0.0),
    ("max_composer_popularity", "double", 0.0),
    ("music_prestige_score", "double", 0.0),
    ("wikipedia_worldwide_box_office", "double", 0.0),
    ("wikipedia_budget", "double", 0.0),
    ("overview", "string", ""),
    ("primary_genre", "string", "Action"),
    ("is_franchise", "int", 0),
    ("is_sequel", "int", 0),
    ("budget_tier", "int", 0),
    ("genre_avg_revenue", "double", 0.0),
    ("description_length", "int", 0),
    ("hype_score", "double", 0.0),
    ("budget_popularity_ratio", "double", 0.0),
    ("vote_power", "double", 0.0),
]

# Valence rules of the published lexicon-and-rule sentiment model.
SENTIMENT_TOKEN_PATTERN = r"[\p{L}\p{N}']+"
INTENSIFIERS = [
    "absolutely", "amazingly", "awfully", "completely", "considerable", "considerably", "decidedly", "deeply",
    "effing", "enormous", "enormously", "entirely", "especially", "exceptional", "exceptionally", "extreme",
    "extremely", "fabulously", "flipping", "flippin", "frackin", "fracking", "fricking", "frickin", "frigging",
    "friggin", "fully", "fuckin", "fucking", "fuggin", "fugging", "greatly", "hella", "highly", "hugely",
    "incredible", "incredibly", "intensely", "major", "majorly", "more", "most", "particularly", "purely", "quite",
    "really", "remarkably", "so", "substantially", "thoroughly", "total", "totally", "tremendous", "tremendously",
    "uber", "unbelievably", "unusually", "utter", "utterly", "very",
]
DAMPENERS = [
    "almost", "barely", "hardly", "kinda", "kindof", "less", "little", "marginal", "marginally", "occasional",
    "occasionally", "partly", "scarce", "scarcely", "slight", "slightly", "somewhat", "sorta", "sortof",
]
DAMPENING_PAIRS = ["just enough", "kind of", "sort of"]
BOOSTERS = {w: 0.293 for w in INTENSIFIERS} | {w: -0.293 for w in [*DAMPENERS, *DAMPENING_PAIRS]}
NEGATIONS = [
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "ain't", "aren't", "can't",
    "couldn't", "daren't", "didn't", "doesn't", "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt",
    "neither", "don't", "hadn't", "hasn't", "haven't", "isn't", "mightn't", "mustn't", "neednt", "needn't", "never",
    "no", "none", "nope", "nor", "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt", "wasnt", "werent",
    "oughtn't", "shan't", "shouldn't", "wasn't", "weren't", "without", "wont", "wouldnt", "won't", "wouldn't",
    "rarely", "seldom", "despite",
]
NEGATION_FACTOR = -0.74
BOOSTER_DECAY = [1.0, 0.95, 0.9]
COMPOUND_ALPHA = 15.0
