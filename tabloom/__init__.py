"""tabloom: profiling, preparing, selecting, modelling and ranking labelled tables on Spark."""
