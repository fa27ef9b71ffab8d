"""siftlane.streaming"""
