"""Names, word lists and settings that results depend on."""

# Words removed in addition to the default English stop words.
# "one " carries a trailing blank that no token can carry; see stop_words().
EXTRA_STOP_WORDS = ["one ", "br", "Po", "th", "sayi", "fo", "unknown"]

# The default English stop words.
ENGLISH_STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours",
    "yourself", "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself",
    "it", "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "these", "those", "am", "is", "are", "was", "were", "be",
    "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for",
    "with", "about", "against", "between", "into", "through", "during", "before", "after",
    "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under",
    "again", "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor", "not",
    "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd",
    "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're",
    "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't",
    "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's",
    "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
]

# Characters removed from text before tokenising.
REMOVED_CHARACTERS = r"[\?,.]"

# The literal that stands for a missing value.
MISSING = "NA"

# House-price columns that are encoded as categories.
HOUSE_CATEGORIES = [
    "Street", "LotShape", "LandContour", "LotConfig", "LandSlope", "Neighborhood",
    "Condition1", "Condition2", "BldgType", "HouseStyle", "OverallQual", "OverallCond",
    "YearBuilt", "YearRemodAdd", "RoofStyle", "RoofMatl", "ExterQual", "ExterCond",
    "Foundation", "Heating", "HeatingQC", "CentralAir", "PavedDrive", "MoSold", "YrSold",
    "SaleCondition",
]

# House-price key, target, always-dropped column and outlier bound.
HOUSE_KEY = "Id"
HOUSE_TARGET = "SalePrice"
HOUSE_DROPPED = ["Electrical"]
HOUSE_OUTLIER_COLUMN = "GrLivArea"
HOUSE_OUTLIER_BOUND = 4500

# Seeds of the random splits and forests.
TEXT_SEED = 10
TABULAR_SEED = 42

# Logistic regression settings. SPARSE keeps no weight on rare-positive
# text; BALANCED is the setting that predicts both classes; TABULAR follows a PCA.
SPARSE_LOGISTIC = {"maxIter": 10, "regParam": 0.3, "elasticNetParam": 0.8}
BALANCED_LOGISTIC = {"maxIter": 10, "regParam": 0.01, "elasticNetParam": 0.0}
TABULAR_LOGISTIC = {"maxIter": 10, "regParam": 0.1, "elasticNetParam": 0.8}

# Linear regression iterations and the tuning grids.
LINEAR_MAX_ITER = 10
LINEAR_GRID = {"regParam": [0.1], "fitIntercept": [True, False], "elasticNetParam": [0.5]}
LINEAR_TRAIN_RATIO = 0.80
TEXT_GRID_FEATURES = [10, 100, 1000]
TEXT_GRID_REG = [0.1, 0.01]
TEXT_FOLDS = 2
TUNING_PARALLELISM = 2

# Width of hashed term vectors, category bound of the vector indexer and
# number of principal components.
TEXT_FEATURES = 262144
MAX_CATEGORIES = 4
COMPONENTS = 3
