"""The steps of the order pipeline and its reports, as DataFrame to DataFrame functions."""
