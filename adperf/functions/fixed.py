"""Fixed values.

Spellings, thresholds, factors and patterns the results depend on. They are
domain data, not logic: every operator takes them as default arguments, so a
caller with other data passes other tables.
"""

from __future__ import annotations

# ---- Fixed values: spellings seen in raw data and their standard form --------
CLICK_AD_TYPES = {
    "video": "Video",
    "Vedeo": "Video",
    "IMAGE": "Image",
    "Carusel": "Carousel",
    "vide": "Video",
}
CATALOG_AD_TYPES = {
    "video": "Video",
    "Vedeo": "Video",
    "IMAGE": "Image",
    "Carusel": "Carousel",
}
CLICK_DEVICES = {
    "moble": "Mobile",
    "DESKTOP": "Desktop",
    "desktop": "Desktop",
    "tablet": "Tablet",
}
CATALOG_DEVICES = {"moble": "Mobile", "DESKTOP": "Desktop", "Mobile": "Mobile"}
PLATFORMS = {"gogle": "google", "facebok": "facebook"}
CATEGORIES = {
    "Eletronics": "Electronics",
    "electronics": "Electronics",
    "fashion": "Fashion",
    "travel": "Travel",
    "health": "Health",
    "gaming": "Gaming",
    "food": "Food",
    "Corrupted_Category": "Unknown",
}
AD_TYPE_PLACEHOLDERS = {
    "0": "Carousel",
    "unknown": "Carousel",
    "Unknown": "Carousel",
    "none": "Carousel",
    "None": "Carousel",
    "": "Carousel",
}
PLATFORM_PLACEHOLDERS = {"unknown": "other", "none": "other", "": "other"}

# ---- Fixed values: allowed domains -------------------------------------------
ALLOWED_CATEGORIES = ["Electronics", "Fashion", "Travel", "Health", "Gaming", "Food"]
ALLOWED_CATALOG_DEVICES = ["Desktop", "Mobile", "Tablet", "All-Devices"]
ALLOWED_AD_TYPES = ["Video", "Image", "Text", "Carousel"]
EXPECTED_CLICK_DEVICES = ["Desktop", "Mobile", "Tablet", "moble", "DESKTOP"]
EXPECTED_PLATFORMS = ["google", "facebook", "instagram", "gogle", "facebok", "Unknown"]
EXPECTED_GENDERS = ["Male", "Female", "Other"]
EXPECTED_CLICK_AD_TYPES = ["Video", "Image", "Text", "video", "IMAGE"]
ALL_DEVICES = "All-Devices"

# ---- Fixed values: patterns and formats --------------------------------------
SLASH_TIMESTAMP = r"^\d{2}/\d{2}/\d{4} \d{2}:\d{2}$"
TIMESTAMP_FORMATS = {
    r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$": "yyyy-MM-dd HH:mm:ss",
    SLASH_TIMESTAMP: "dd/MM/yyyy HH:mm",
}
PROFILE_TIMESTAMP_FORMATS = {
    **TIMESTAMP_FORMATS,
    r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$": "yyyy-MM-dd HH:mm",
}
LEADING_AGE = r"^\d+\s+"
LEADING_AGE_THEN_DEVICE = r"^\d+\s+(\w+)"
AD_ID = r"^AD_[0-9]{6}$"
UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
SENTINEL_FUTURE = "2035-12-25 12:00:00"

# ---- Fixed values: cleaning constants ----------------------------------------
WATCH_LIMITS = (0.0, 180.0)
AGE_LIMITS = (18, 100)
AGE_BELOW, AGE_ABOVE, AGE_MISSING = 25, 35, 30
SESSION_GAP_SECONDS = 1800

# ---- Fixed values: feature constants -----------------------------------------
DAY_PART_EDGES = [6, 12, 18, 22]
DAY_PARTS = ["Late_Night", "Morning", "Afternoon", "Evening_Prime", "Late_Night"]
AGE_EDGES = [25, 35, 50]
AGE_BANDS = ["18-24", "25-34", "35-49", "50+"]
DISPLAY_AGE_BANDS = [
    "18-25 (Gen Z)",
    "26-35 (Millennials)",
    "36-50 (Gen X)",
    "50+ (Boomers)",
]
DED_STEPS = [(0.7, 0.95), (0.4, 0.6), (0.2, 0.3)]
DED_FLOOR = 0.1
CONVERTING_AGES = (25, 45)
CONVERSION_WATCH_RATIO = 0.5
CONVERSION_PERCENT = 30
WIN_ROAS = 2.0
ENGAGEMENT_WEIGHTS = {"avg_watch_ratio": 0.3, "ctr": 0.4, "conversion_rate": 0.3}
LIFECYCLE_EDGES = [7, 30, 60]
LIFECYCLE_STAGES = ["New", "Growing", "Mature", "Declining"]
LOCATION_TYPES = {
    "Maharashtra": "Urban",
    "Delhi": "Urban",
    "Karnataka": "Urban",
    "Tamil Nadu": "Semi-Urban",
}
SEASONS = {
    12: "Winter", 1: "Winter", 2: "Winter",
    3: "Spring", 4: "Spring", 5: "Spring",
    6: "Summer", 7: "Summer", 8: "Summer",
    9: "Fall", 10: "Fall", 11: "Fall",
}
DAY_NAMES = {
    1: "Sunday", 2: "Monday", 3: "Tuesday", 4: "Wednesday",
    5: "Thursday", 6: "Friday", 7: "Saturday",
}

# ---- Fixed values: key-based draws (multiplier, modulus) ---------------------
CONVERSION_DRAW = (7919, 100)
REVENUE_DRAW = (104729, 1000)
SPLIT_DRAW = (15485863, 10007)

# ---- Fixed values: score bands -----------------------------------------------
EFFICIENCY_BANDS = [
    (0.4, "Excellent (>0.4)"),
    (0.25, "Good (0.25-0.4)"),
    (0.15, "Average (0.15-0.25)"),
]
EFFICIENCY_FLOOR = "Poor (<0.15)"
ENGAGEMENT_BANDS = [(0.7, "High (>0.7)"), (0.5, "Medium (0.5-0.7)")]
ENGAGEMENT_FLOOR = "Low (<0.5)"
MATRIX_BANDS = [(2.75, "strong"), (2.0, "fair")]
WASTE_ROAS = 1.8

# ---- Fixed values: code numbers of categorical model inputs -------------------
CATEGORY_CODES = {
    "electronics": 0, "fashion": 1, "health": 2, "food": 3, "gaming": 4, "travel": 5,
}
DEVICE_CODES = {
    "all-devices": 0, "all devices": 0, "mobile": 1, "desktop": 2, "tablet": 3,
}
TYPE_CODES = {"video": 0, "image": 1, "text": 2, "carousel": 3}
LOCATION_CODES = {
    "maharashtra": 0, "delhi": 1, "karnataka": 2, "tamil nadu": 3, "uttar pradesh": 4,
}

# ---- Fixed values: forecast factors, listed by code number --------------------
CATEGORY_BASE = {
    "ctr": [0.0155, 0.0162, 0.0148, 0.0168, 0.0175, 0.0152],
    "conversion": [0.0228, 0.0238, 0.0215, 0.0248, 0.0258, 0.0222],
    "roas": [2.15, 2.28, 2.08, 2.35, 2.42, 2.18],
}
CATEGORY_FACTOR = {
    "ctr": [0.97, 1.03, 0.94, 1.06, 1.08, 0.96],
    "roas": [0.96, 1.04, 0.92, 1.07, 1.10, 0.97],
    "conversion": [0.96, 1.03, 0.93, 1.06, 1.09, 0.95],
}
TYPE_FACTOR = {
    "ctr": [1.18, 1.00, 0.82, 1.10],
    "roas": [1.12, 1.00, 0.86, 1.07],
    "conversion": [1.15, 1.00, 0.84, 1.08],
}
DEVICE_FACTOR = {
    "ctr": [1.00, 1.12, 0.92, 0.82],
    "roas": [1.00, 1.10, 0.93, 0.85],
    "conversion": [1.00, 1.10, 0.93, 0.84],
}
LOCATION_FACTOR = [1.03, 1.06, 1.00, 0.96, 0.92]
VIDEO_LENGTH_FACTORS = [((10, 20), 1.08), ((20, 30), 1.03)]
VIDEO_LONG_FACTOR = 0.90
