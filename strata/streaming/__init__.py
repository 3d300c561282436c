"""Streaming: the reference has no stream, watermark, streaming window or stateful
operator, so nothing is built here.  Every operator in this package is a plain
DataFrame -> DataFrame function, so the row-wise ones (text cleaning, key building,
geometry) also apply unchanged to a ``readStream`` DataFrame."""
