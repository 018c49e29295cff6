"""Part of Tidewell; see README."""
