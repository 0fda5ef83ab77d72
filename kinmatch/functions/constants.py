"""Spellings, dictionaries and defaults that results depend on."""

# Fixed values. Null spellings, compared after Unicode normalisation.
MISSING = ("", "null", "<null>", "none", "<none>", "n/a", "na", "nan", "<na>", "-", "--")

# Fixed values. Legal forms by abbreviation, and those that a core name loses at its end.
LEGAL_FORMS = {"pvt": "private", "ltd": "limited", "corp": "corporation", "co": "company", "inc": "incorporated", "llp": "llp", "llc": "llc"}
LEGAL_SUFFIXES = ("private", "limited", "corporation", "company", "incorporated", "llp", "llc", "plc", "sarl", "sas", "sasu", "eurl")

# Fixed values. Country spellings.
COUNTRY_KEYS = {"india": "IN", "in": "IN", "ind": "IN", "us": "US", "usa": "US", "united states": "US", "united states of america": "US", "fr": "FR", "fra": "FR", "france": "FR"}

# Fixed values. States of the United States with the District of Columbia, by postal code.
US_STATES = {
    "AL": "alabama", "AK": "alaska", "AZ": "arizona", "AR": "arkansas", "CA": "california", "CO": "colorado", "CT": "connecticut", "DE": "delaware",
    "FL": "florida", "GA": "georgia", "HI": "hawaii", "ID": "idaho", "IL": "illinois", "IN": "indiana", "IA": "iowa", "KS": "kansas", "KY": "kentucky",
    "LA": "louisiana", "ME": "maine", "MD": "maryland", "MA": "massachusetts", "MI": "michigan", "MN": "minnesota", "MS": "mississippi", "MO": "missouri",
    "MT": "montana", "NE": "nebraska", "NV": "nevada", "NH": "new hampshire", "NJ": "new jersey", "NM": "new mexico", "NY": "new york",
    "NC": "north carolina", "ND": "north dakota", "OH": "ohio", "OK": "oklahoma", "OR": "oregon", "PA": "pennsylvania", "RI": "rhode island",
    "SC": "south carolina", "SD": "south dakota", "TN": "tennessee", "TX": "texas", "UT": "utah", "VT": "vermont", "VA": "virginia", "WA": "washington",
    "WV": "west virginia", "WI": "wisconsin", "WY": "wyoming", "DC": "district of columbia",
}

# Fixed values. States and union territories of India.
INDIA_STATES = (
    "andhra pradesh", "arunachal pradesh", "assam", "bihar", "chhattisgarh", "goa", "gujarat", "haryana", "himachal pradesh", "jharkhand", "karnataka",
    "kerala", "madhya pradesh", "maharashtra", "manipur", "meghalaya", "mizoram", "nagaland", "odisha", "punjab", "rajasthan", "sikkim", "tamil nadu",
    "telangana", "tripura", "uttar pradesh", "uttarakhand", "west bengal", "delhi", "chandigarh", "puducherry", "jammu and kashmir", "ladakh",
    "lakshadweep", "andaman and nicobar islands", "dadra and nagar haveli and daman and diu",
)

# Fixed values. Road words by abbreviation and country, and words that don't tell a city's streets apart.
ROAD_WORDS = {"rd": "road", "ave": "avenue", "av": "avenue", "blvd": "boulevard", "ln": "lane", "hwy": "highway"}
ROAD_WORDS_AFTER_NUMBER = {"st": "street", "dr": "drive"}
ROAD_WORDS_IN = {"nr": "near"}
ROAD_WORDS_FR = {"av": "avenue", "bd": "boulevard"}
LOCALITY_WORDS = ("nagar", "colony", "sector", "phase", "locality")
CITY_STOP_WORDS = ("road", "street", "avenue", "lane", "block", "near", "and", "the")

# Fixed values. Weights of the retrieval score: name, address, equal name, each channel.
SCORE_WEIGHTS = (0.55, 0.30, 0.10, 0.01)
CHANNELS = ("A", "B", "C", "D", "E", "F")

# Fixed values. The pair features, in the order in which models take them.
FEATURES = (
    "name_levenshtein_ratio", "name_jaro_winkler", "name_token_jaccard", "name_tfidf_cosine", "name_char_ngram_similarity", "name_exact",
    "name_without_suffix_similarity", "name_expanded_similarity", "address_levenshtein", "address_edit_distance", "address_token_jaccard",
    "address_tfidf_cosine", "address_char_similarity", "postal_code_exact", "city_exact", "state_exact", "house_number_exact", "country_exact",
    "address_exact", "name_address_similarity_product", "name_missing", "address_missing", "name_missing_left", "name_missing_right",
    "address_missing_left", "address_missing_right", "name_missing_both", "address_missing_both", "postal_missing", "city_missing", "state_missing",
    "house_number_missing", "name_length_ratio", "address_length_ratio",
)
MODEL_COLUMNS = (*FEATURES, "candidate_source", "candidate_rank", "retrieval_score", "name_retrieval_cosine", "address_retrieval_cosine", *(f"block_{c}" for c in CHANNELS))
FORBIDDEN_FEATURES = ("source1_entity_id", "candidate_entity_id", "dataset_split", "label")

# Fixed values. Columns of records and pairs.
RAW_COLUMNS = ("entity_id", "business_name", "business_address", "country")
TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")
INDEX_COLUMNS = (
    "entity_id", "country_key", "name_basic", "name_expanded", "name_without_suffix", "name_latin_folded", "address_normalized", "address_latin_folded",
    "postal_code_candidate", "state_candidate", "city_candidate", "house_number_zero_normalized", "name_missing", "address_missing",
)
