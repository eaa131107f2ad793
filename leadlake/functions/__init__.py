"""Column -> Column expressions. Import from here."""

from .events import (  # noqa: F401
    EMAIL_RESPONSE,
    PASSTHROUGH,
    SMS_RESPONSE,
    SMS_RESPONSE_CORRECTED,
    WHATSAPP_ENGAGEMENT,
    WHATSAPP_RESPONSE,
    canonical_event,
    sms_engagement_event,
)
from .flags import (  # noqa: F401
    booked_date,
    booked_flag,
    call_connected,
    flag_if,
    lead_temperature,
    null_to_false,
    site_visit_completed,
    site_visit_scheduled,
    sms_raw_status,
)
from .text import digits, is_present, normalize_phone, phone_key  # noqa: F401
from .time import LOCAL_TZ, local_event_time, local_event_time_from_epoch_ms  # noqa: F401
