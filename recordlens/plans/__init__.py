"""Jobs: functions from input frames to result frames."""
