"""Domains, thresholds and formats the reports are defined by."""

# --- fixed values (must stay as they are for results to be right) ---------------------
MIN_CALL_MS = 180_000
OPEN_END = "2099-12-31"
SHIFT_BREAK_SECONDS = 5_400
DEFAULT_SHIFT_SECONDS = 34_200
EIGHT_HOURS_SECONDS = 28_800
WORK_HOURS = ("093000", "223000")
DEVICE_PATTERN = "T[0-9]{4}"
DELETED_DEVICE_COMMENT = "To be Delete Row"
LOST_FLAG_OUTCOME = "sale_unsuccessful"
LOST_CALL_OUTCOME = "unsuccessful"
SALES_TYPE = "sales"
FOLLOW_UP_ISSUES = ["Uncertainty in dimension", "Deferred decision making", "Technical Glitch"]
LOSS_CATEGORIES = ["Customer", "Product", "Process", "Price", "Salesperson"]
OBJECTION_CATEGORIES = [
    "merchandise_issue",
    "price_issue",
    "others",
    "offers_and_discount_issue",
    "after_sales_issue",
    "customization_issue",
    "delivery_timeline_issue",
    "negative_past_experience",
]
OBJECTION_LABELS = {
    "merchandise_issue": "Merchandise Issue",
    "price_issue": "Price Issue",
    "others": "Others",
    "offers_and_discount_issue": "Offers and Discount Issue",
    "after_sales_issue": "After Sales Issue",
    "customization_issue": "Customization Issue",
    "delivery_timeline_issue": "Delivery Timeline Issue",
    "negative_past_experience": "Negative Past Experience",
}
HANDLINGS = ["Explanation", "Solution", "Generic"]
NO_OBJECTION = ["not_applicable"]
SCHEME_BENEFITS = [
    "gms_monthly_payment",
    "gms_redemption_exclusion",
    "gms_rules_penalties",
    "gms_redemption_flexibility",
    "gms_benefit_stacking",
]
BLANK_ALERT_PCT = 8
ADHERENCE_ALERT_PCT = 85
BANDS = [(85, "on_track"), (75, "watch"), (60, "behind")]
LOWEST_BAND = "critical"
GRAND_TOTAL = "Grand Total"
# Date and time texts beside ISO, in the order they are tried; month before day where both could be.
TIME_FORMATS = [
    "yyyy/M/d[ H:mm[:ss]]",
    "M/d/yyyy[ H:mm[:ss]]",
    "M-d-yyyy[ H:mm[:ss]]",
    "M/d/yyyy h:mm[:ss] a",
    "d/M/yyyy[ H:mm[:ss]]",
    "d-M-yyyy[ H:mm[:ss]]",
    "d MMM yyyy[ H:mm[:ss]]",
    "d-MMM-yyyy[ H:mm[:ss]]",
    "MMM d, yyyy[ H:mm[:ss]]",
]
# Units of interval texts in falling order, with the seconds SQL intervals give them.
INTERVAL_UNITS = [
    ("years?|yrs?|y", 31_557_600),
    ("months?|mons?", 2_592_000),
    ("weeks?|w", 604_800),
    ("days?|d", 86_400),
    ("hours?|hrs?|h", 3_600),
    ("minutes?|mins?|m", 60),
    ("seconds?|secs?|s", 1),
    ("milliseconds?|msecs?|ms", 0.001),
]
# --------------------------------------------------------------------------------------
