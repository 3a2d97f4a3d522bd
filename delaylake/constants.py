"""They have to be exactly these for results to agree with the pipeline we replace."""

# Airports served, with the city shown to users; CDG is the hub all flights arrive at.
AIRPORT_CITIES = {
    "NCE": "Nice",
    "TLS": "Toulouse",
    "LYS": "Lyon",
    "MRS": "Marseille",
    "BOD": "Bordeaux",
    "CDG": "Paris Charles de Gaulle",
}
HUB_AIRPORT = "CDG"
EXPECTED_AIRPORTS = ("NCE", "LYS", "MRS", "TLS", "BOD")

# Carrier and movement filter of the flight source.
CARRIER = "AF"

# Local time zone of every airport above.
LOCAL_TIME_ZONE = "Europe/Paris"

# User-visible lookup messages.
MESSAGE_NO_PREDICTION = "Aucune prédiction trouvée pour ce vol."
MESSAGE_UNKNOWN_AIRPORT = "Aéroport inconnu : "
MESSAGE_UNKNOWN_ORIGIN = "Aéroport d'origine inconnu : "
MESSAGE_UNKNOWN_DESTINATION = "Aéroport de destination inconnu : "
MESSAGE_BAD_HOUR = "L'heure doit être entre 0 et 23."
MESSAGE_SAME_AIRPORT = "Origine et destination identiques."

# Delay thresholds in minutes.
ON_TIME_MAX_MINUTES = 0
MINOR_DELAY_MAX_MINUTES = 15
MAJOR_DELAY_MIN_MINUTES = 60

# Freshness window of the readiness checks.
READINESS_HOURS = 2

# Business keys.
FLIGHT_KEY = ("flight_id", "flight_number", "date", "origin_airport", "destination_airport")
WEATHER_KEY = ("date", "airport_iata")
PREDICTION_KEY = ("flight_number", "flight_date")

# Columns an upsert replaces; all others keep their first value.
PREDICTION_UPDATED_COLUMNS = (
    "dep_hour",
    "is_delayed",
    "prediction_date",
    "run_id",
    "model_name",
    "model_version",
)

# Null-rate alarm thresholds (percent) per step.
NULL_ALARM_FLIGHTS = 0.0
NULL_ALARM_WEATHER = 20.0
NULL_ALARM_DEFAULT = 50.0

# Model features and gates.
CLASSIFIER_CATEGORICAL = ("origin_airport", "destination_airport", "departure_time_block", "weather_code")
CLASSIFIER_NUMERIC = (
    "day_of_week",
    "month",
    "dep_hour",
    "arr_hour",
    "precipitation_sum",
    "wind_speed_max",
    "wind_gusts_max",
    "temp_min",
)
REGRESSOR_FEATURES = (
    "origin_airport",
    "destination_airport",
    "departure_time_block",
    "weather_code",
    "type_code",
    "day_of_week",
    "month",
    "dep_hour",
    "arr_hour",
    "precipitation_sum",
    "wind_speed_max",
    "wind_gusts_max",
    "temp_min",
    "wind_direction",
    "precipitation_hours",
    "temp_max",
)
CLASSIFIER_REGISTRY = "flight_delay_model"
REGRESSOR_REGISTRY = "flight_delay_regression_model"
F1_STAGING_MIN = 0.4
MAE_STAGING_MAX = 30.0
MIN_REGRESSION_ROWS = 50
TEST_SHARE = 0.2
SEED = 42

# Display names of model classes that differ from the class name.
MODEL_DISPLAY_NAMES = {
    "RandomForest": "RandomForest",
    "LogisticRegression": "LogisticRegression",
    "XGB": "XGBoost",
}
