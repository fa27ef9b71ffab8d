"""siftlane.plans"""
