"""Fixed values that results have to agree on, stated once."""

# City -> (latitude, longitude) of its centre, in degrees.
CITY_CENTERS = {
    "LA": (34.0522, -118.2437),
    "NY": (40.7128, -74.0060),
}

# Columns typed as double while cleaning.
DOUBLE_COLUMNS = (
    "price",
    "latitude",
    "longitude",
    "minimum_nights",
    "number_of_reviews",
    "reviews_per_month",
    "calculated_host_listings_count",
    "availability_365",
    "number_of_reviews_ltm",
)

# What a missing review field means.
REVIEW_DEFAULTS = {"reviews_per_month": 0.0, "number_of_reviews_ltm": 0.0}

# Identifier-like columns that carry no signal.
IDENTIFIER_COLUMNS = ("host_id", "host_name", "name")

# Columns without which no model frame can be built.
REQUIRED_COLUMNS = ("price", "latitude", "longitude", "room_type", "neighbourhood_group")

# Model inputs, in feature-vector order.
NUMERIC_FEATURES = (
    "minimum_nights",
    "number_of_reviews",
    "reviews_per_month",
    "availability_365",
    "calculated_host_listings_count",
    "number_of_reviews_ltm",
    "dist_to_center",
    "latitude",
    "longitude",
)
CATEGORICAL_FEATURES = ("room_type", "neighbourhood_group")

# Columns of the correlation matrix.
CORRELATION_COLUMNS = (
    "price",
    "minimum_nights",
    "number_of_reviews",
    "reviews_per_month",
    "availability_365",
    "calculated_host_listings_count",
    "number_of_reviews_ltm",
    "latitude",
    "longitude",
)

# Price range kept for charts, tail percentiles, histogram bins.
PRICE_CAP = (0.0, 2000.0)
TAIL_PERCENTAGES = (0.95, 0.99)
QUARTILE_PERCENTAGES = (0.25, 0.5, 0.75)
HISTOGRAM_BINS = 50

# Train share (percent) and seed of the split, and regressor settings.
TRAIN_PERCENT = 80
SPLIT_SEED = 42
LINEAR_PARAMS = {"maxIter": 50, "regParam": 0.1, "elasticNetParam": 0.5}
FOREST_PARAMS = {"numTrees": 100, "maxDepth": 8, "maxBins": 32, "seed": 42}
BOOSTED_PARAMS = {
    "maxIter": 30,
    "maxDepth": 4,
    "maxBins": 32,
    "stepSize": 0.1,
    "subsamplingRate": 0.8,
    "seed": 42,
}
