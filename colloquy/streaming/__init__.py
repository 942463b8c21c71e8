"""Extensions for streams of timed rows; the batch operators have no counterpart with late data."""
