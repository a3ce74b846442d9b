"""Parameters and fixed values of the incident engine.

Everything a run can tune lives in :class:`EngineConfig`.  The lookup tables
below are fixed values that must equal the behaviour we reproduce; they are
kept here, plainly, in their natural order, and become literals of column expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reproduced behaviour; do not edit)
# ---------------------------------------------------------------------------

LOCAL_TIMEZONE = "Asia/Kolkata"
CITY_CENTER = (12.9716, 77.5946)
BBOX = {"min_lat": 12.80, "max_lat": 13.27, "min_lng": 77.30, "max_lng": 77.77}
EARTH_RADIUS_KM = 6371.0

RUSH_HOURS_MORNING = [8, 9, 10]
RUSH_HOURS_EVENING = [17, 18, 19, 20]
NIGHT_START = 22
NIGHT_END = 6

TIMESTAMP_COLUMNS = [
    "start_datetime",
    "end_datetime",
    "created_date",
    "modified_datetime",
    "closed_datetime",
    "resolved_datetime",
]

CAUSE_NORMALIZATION = {
    "Debris": "debris",
    "Fog / Low Visibility": "fog_low_visibility",
    "test_demo": "others",
}

CATEGORICAL_FILL = ["corridor", "zone", "police_station", "junction", "veh_type", "direction", "gba_identifier"]
UNKNOWN = "unknown"

STATUS_CODES = {"active": 0, "resolved": 1, "closed": 2}

CAUSE_SEVERITY_RANK = {
    "vip_movement": 10,
    "protest": 9,
    "procession": 8,
    "public_event": 8,
    "accident": 7,
    "tree_fall": 6,
    "water_logging": 5,
    "construction": 5,
    "congestion": 4,
    "vehicle_breakdown": 3,
    "road_conditions": 3,
    "pot_holes": 2,
    "debris": 2,
    "fog_low_visibility": 4,
    "others": 3,
}
CAUSE_SEVERITY_DEFAULT = 3

PLANNED_CAUSES = ["construction", "public_event", "procession", "vip_movement", "protest"]
INFRASTRUCTURE_CAUSES = ["pot_holes", "road_conditions", "water_logging", "debris"]
VEHICLE_CAUSES = ["vehicle_breakdown", "accident"]
NATURE_CAUSES = ["tree_fall", "fog_low_visibility"]

VEHICLE_SEVERITY = {
    "heavy_vehicle": 5,
    "truck": 5,
    "private_bus": 4,
    "bmtc_bus": 4,
    "ksrtc_bus": 4,
    "lcv": 3,
    "others": 2,
    "private_car": 2,
    "taxi": 2,
    "auto": 1,
    "unknown": 0,
}
VEHICLE_SEVERITY_DEFAULT = 0

DESC_PATTERNS = {
    "desc_has_traffic_slow": "slow|traffic|congestion|jam",
    "desc_has_road_closed": "closed|closure|block|barricad",
    "desc_has_accident": "accident|collision|hit|crash",
}

TIME_PERIODS = [
    # (label, predicate over local hour), first match wins
    ("early_morning", "hour >= 6 AND hour < 10"),
    ("midday", "hour >= 10 AND hour < 14"),
    ("afternoon", "hour >= 14 AND hour < 17"),
    ("evening", "hour >= 17 AND hour < 21"),
    ("late_night", "hour >= 21 OR hour < 2"),
    ("pre_dawn", "hour >= 2 AND hour < 6"),
]

TARGET_ENCODING_SMOOTHING = 10
TARGET_ENCODING_KEYS = ["event_cause", "corridor", "zone", "police_station"]
TARGET_ENCODING_TARGETS = ["priority_binary", "road_closure_binary"]

# Rolling look-back counts used as features: (feature, key column or None for city-wide, hours)
LAG_FEATURES = [
    ("events_same_corridor_24h", "corridor", 24),
    ("events_same_zone_7d", "zone", 168),
    ("events_same_ps_24h", "police_station", 24),
    ("total_events_last_6h", None, 6),
]
LAG_WINDOWS_HOURS = [6, 12, 24, 48, 168]

MANPOWER_BASE = {
    "vehicle_breakdown": 2,
    "accident": 4,
    "tree_fall": 3,
    "water_logging": 3,
    "construction": 3,
    "public_event": 8,
    "procession": 10,
    "vip_movement": 12,
    "protest": 10,
    "congestion": 4,
    "pot_holes": 2,
    "road_conditions": 2,
    "others": 2,
}
MANPOWER_BASE_DEFAULT = 2
SEVERITY_MULTIPLIER = {"High": 1.5, "Low": 1.0}
RUSH_HOUR_MULTIPLIER = 1.3
ROAD_CLOSURE_MULTIPLIER = 1.5
BARRICADE_BASE = {"full_closure": 12, "partial_closure": 6, "no_closure": 0}

ALERT_LEVELS = [
    # (level, color, description)
    (1, "GREEN", "Low impact — standard monitoring"),
    (2, "BLUE", "Moderate impact — increased monitoring"),
    (3, "YELLOW", "Significant impact — active management required"),
    (4, "ORANGE", "High impact — urgent resource deployment"),
    (5, "RED", "Critical — maximum resource deployment"),
]

BASE_EQUIPMENT = ["Walkie-talkies", "Reflective jackets", "Whistles"]
CAUSE_EQUIPMENT = {
    "accident": ["First aid kit", "Fire extinguisher", "Tow truck", "Ambulance on standby"],
    "tree_fall": ["Chainsaw", "JCB/crane", "Warning lights"],
    "water_logging": ["Water pump", "Sandbags", "High-visibility markers"],
    "construction": ["Traffic cones", "Diversion signage", "Speed limit boards"],
    "public_event": ["PA system", "Crowd control barriers", "CCTV van"],
    "procession": ["PA system", "Crowd control barriers", "Route markers"],
    "vip_movement": ["Escort vehicles", "Radio communication", "Route clearance team"],
    "vehicle_breakdown": ["Tow truck", "Warning triangle", "Push crew"],
    "protest": ["Crowd control barriers", "Water cannon on standby", "Riot gear"],
}

COMMUNICATION_ACTIONS = [
    # (minimum alert level, action)
    (1, "Update control room dashboard"),
    (2, "Notify nearby patrol units"),
    (2, "Update Google Maps / Waze via API"),
    (3, "Send SMS alerts to registered commuters"),
    (3, "Post on social media (Twitter/X)"),
    (3, "Notify local media"),
    (4, "Activate emergency response protocol"),
    (4, "Notify senior officers / ACP"),
    (5, "Notify Commissioner's office"),
    (5, "Request military / NDRF assistance if needed"),
]

COST_RATES = {"officer": 500, "constable": 300, "support": 200, "barricade": 50}
EQUIPMENT_COST = {"closure": 2000, "no_closure": 500}
NAIVE_PLAN = {"personnel": 12, "barricades": 12, "equipment": 2000}

DIVERSIONS = {
    # corridor: (primary, secondary, avoid)
    "Bellary Road 1": ("Palace Road → Sankey Road → Sadashivanagar", "Cunningham Road → Vasanth Nagar", "Mekhri Circle during rush hours"),
    "Bellary Road 2": ("Hebbal Flyover → ORR North", "BEL Road → Jalahalli", "Esteem Mall Junction"),
    "Mysore Road": ("Chord Road → Vijayanagar", "Kanakapura Road via RR Nagar", "Sirsi Circle during events"),
    "Tumkur Road": ("ORR → Yeshwanthpur via Rajajinagar", "Magadi Road → Chord Road", "Goraguntepalya Junction"),
    "Hosur Road": ("Bannerghatta Road → JP Nagar", "ORR East via Silk Board", "Silk Board Junction always"),
    "Bannerghata Road": ("Hosur Road → BTM Layout", "Kanakapura Road → JP Nagar", "Jayadeva Junction during peak"),
    "ORR East 1": ("Old Airport Road → HAL", "Sarjapur Road → Outer Ring Road", "Marathahalli Junction"),
    "ORR East 2": ("Whitefield Road → ITPL Road", "Old Madras Road via KR Puram", "KR Puram Junction during peak"),
    "ORR North 1": ("Hennur Road → Banaswadi", "Thanisandra Road → Nagavara", "Hebbal Flyover during rush"),
    "ORR North 2": ("Hennur Road → Kalyan Nagar → Ramamurthy Nagar", "Thanisandra Road → Bagalur Road", "Nagavara Junction during peak"),
    "Old Madras Road": ("CMH Road → Indiranagar", "ORR via KR Puram", "Trinity Circle"),
    "Magadi Road": ("Chord Road → Vijayanagar", "Tumkur Road via Yeshwanthpur", "Magadi Road Flyover during construction"),
    "West of Chord Road": ("Magadi Road → Rajajinagar Industrial Area", "Tumkur Road → Yeshwanthpur Circle", "Mahalakshmi Layout during peak hours"),
    "ORR West 1": ("Mysore Road → RR Nagar → Kengeri", "Chord Road → Vijayanagar → Attiguppe", "Nayandahalli Junction during peak"),
    "CBD 1": ("Residency Road → Richmond Road → Hosur Road", "MG Road → Trinity Circle → Old Airport Road", "Corporation Circle during office hours"),
    "CBD 2": ("MG Road → Brigade Road → Residency Road", "JC Road → KR Road → Mysore Road", "Town Hall area during rallies"),
    "Hennur Main Road": ("ORR North → Kalyan Nagar → Banaswadi", "Thanisandra Road → Jakkur → Yelahanka", "Hennur Bande Junction during peak"),
    "IRR(Thanisandra road)": ("Hennur Road → Hebbal via ORR North", "Bagalur Road → Yelahanka via NH44", "Thanisandra Junction during rush hours"),
    "Varthur Road": ("Whitefield Main Road → ITPL Road → ORR East", "Sarjapur Road → Marathahalli via ORR", "Varthur Kodi Junction during peak"),
    "Old Airport Road": ("ORR East → Indiranagar via CMH Road", "HAL Road → Domlur → Koramangala", "Manipal Hospital Junction during peak"),
    "Airport New South Road": ("Bellary Road → Hebbal Flyover → NH44", "Hennur Road → Kalyan Nagar → ORR", "Mekhri Circle during VIP movement"),
    "Non-corridor": ("Use nearest parallel arterial road", "Navigate via adjacent major corridor", "Event location and 500m radius"),
}
DIVERSION_DEFAULT = (
    "Use adjacent parallel roads via nearest corridor",
    "Check Google Maps for real-time alternatives",
    "Event location and 500m radius",
)
ADVISORY_CLOSURE = "FULL ROAD CLOSURE — All traffic must divert"
ADVISORY_PARTIAL = "PARTIAL DISRUPTION — Expect delays, consider alternate routes"

# 46 raw columns of an incident record, in file order.
RAW_COLUMNS = [
    "id", "event_type", "latitude", "longitude", "endlatitude", "endlongitude",
    "address", "end_address", "event_cause", "requires_road_closure",
    "start_datetime", "end_datetime", "status", "authenticated",
    "modified_datetime", "map_file", "direction", "description",
    "veh_type", "veh_no", "corridor", "priority", "cargo_material",
    "reason_breakdown", "age_of_truck", "created_date", "route_path",
    "client_id", "created_by_id", "last_modified_by_id",
    "assigned_to_police_id", "citizen_accident_id", "comment",
    "police_station", "meta_data", "kgid", "resolved_at_address",
    "resolved_at_latitude", "resolved_at_longitude", "closed_by_id",
    "closed_datetime", "resolved_by_id", "resolved_datetime",
    "gba_identifier", "zone", "junction",
]

# Feature lists (names are the public contract of the feature table).
TEMPORAL_FEATURES = [
    "hour", "minute", "day_of_week", "day_of_month", "month", "week_of_year",
    "is_weekend", "is_morning_rush", "is_evening_rush", "is_rush_hour", "is_night",
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos",
]
SPATIAL_FEATURES = [
    "dist_to_center_km", "is_major_corridor", "corridor_event_frequency",
    "junction_event_frequency", "police_station_event_frequency",
    "lat_grid", "lng_grid",
]
PROFILE_FEATURES = [
    "is_planned", "has_vehicle", "road_closure_binary",
    "cause_severity_rank", "is_planned_cause", "is_infrastructure_cause",
    "is_vehicle_cause", "is_nature_cause", "vehicle_severity",
    "description_length", "desc_has_traffic_slow", "desc_has_road_closed",
    "desc_has_accident", "desc_word_count",
    "has_extent", "event_extent_km", "response_delay_minutes",
]
HISTORICAL_FEATURES = [
    "cause_avg_resolution_hours", "corridor_avg_resolution_hours",
    "cause_historical_closure_rate", "junction_historical_closure_rate",
    "cause_historical_priority_rate",
    "events_same_corridor_24h", "events_same_zone_7d",
    "events_same_ps_24h", "total_events_last_6h",
]
INTERACTION_FEATURES = [
    "rush_x_closure", "planned_x_major_corridor",
    "severity_x_rush", "weekend_x_planned_cause",
    "night_x_vehicle", "dist_x_severity",
    "concurrent_x_severity", "junction_freq_x_closure",
]
ENCODED_FEATURES = [
    "event_cause_te_priority_binary", "corridor_te_priority_binary",
    "zone_te_priority_binary", "police_station_te_priority_binary",
    "event_cause_te_road_closure_binary", "corridor_te_road_closure_binary",
    "zone_te_road_closure_binary", "police_station_te_road_closure_binary",
]
HEX_FEATURES = ["hex_event_count"]
ALL_FEATURES = (
    TEMPORAL_FEATURES + SPATIAL_FEATURES + PROFILE_FEATURES + HISTORICAL_FEATURES
    + INTERACTION_FEATURES + ENCODED_FEATURES + HEX_FEATURES
)
SEVERITY_EXCLUDE = ["road_closure_binary", "rush_x_closure"]
CLOSURE_EXCLUDE = [
    "road_closure_binary", "rush_x_closure",
    "event_cause_te_road_closure_binary", "corridor_te_road_closure_binary",
    "zone_te_road_closure_binary", "police_station_te_road_closure_binary",
    "junction_freq_x_closure",
]

# ---------------------------------------------------------------------------
# Tunable parameters
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class EngineConfig:
    timezone: str = LOCAL_TIMEZONE
    split_date: str = "2024-03-01"          # local date; train < split <= test
    te_smoothing: int = TARGET_ENCODING_SMOOTHING
    lag_bucket_seconds: int = 3600          # time slice that bounds a lag partition
    hex_size_km: float = 0.46               # planar hex edge, ~H3 resolution 8
    fit_scope: str = "train"                # "train" (leakage-free) or "all" (parity)
    dbscan_eps: float = 0.5
    dbscan_min_samples: int = 5
    min_cluster_size: int = 1               # above 1, smaller clusters become noise
    spatial_weight: float = 1.0


DEFAULT = EngineConfig()
