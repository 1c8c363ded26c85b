from waybill.functions.text import WHOLE_NUMBER, strip_blanks
from waybill.functions.time import epoch_to_time, hour_start, iso_utc, time_to_millis

__all__ = ["WHOLE_NUMBER", "epoch_to_time", "hour_start", "iso_utc", "strip_blanks", "time_to_millis"]
